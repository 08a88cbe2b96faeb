"""Compare a DataFrame with the result of SQL run by DuckDB: names, types, all values."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double",
}


def differences(df, con, sql):
    """An empty list if both sides agree."""
    relation = con.sql(sql)
    got = dict(df.dtypes)
    want = {n: SAME_TYPE.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    if got != want:
        return [f"columns {sorted(got.items())} != {sorted(want.items())}"]
    names = sorted(got)
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = con.sql(f"SELECT {quoted} FROM ({sql})").fetchall()
    ours = [tuple(r) for r in df.select(*names).collect()]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)} rows"]
    pairs = zip(sorted(ours, key=repr), sorted(theirs, key=repr))
    return [f"{a} != {b}" for a, b in pairs if a != b][:5]
