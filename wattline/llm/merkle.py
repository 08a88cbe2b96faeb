"""Merkle manifest of a dataset: a tree per source, a tree over the sources, proofs by a butterfly exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import materialize, ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
#: A block holds FANOUT ** BLOCK_LEVELS leaves: the unit that takes part in the exchange.
BLOCK_LEVELS = 2
#: A tree's data come to its nodes by at most so many keys, so that a large tree is not one key.
SALTS = 64

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def counted(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def tree_key(source: Column) -> Column:
    """Never null, and in the order of the sources by UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def siblings(digests: Column, index: Column, fanout: int) -> Column:
    """What a node's run holds left and right of it, each as one text of digests."""
    at = index % fanout
    left = F.slice(digests, index - at + 1, at)
    right = F.slice(digests, index + 2, F.lit(fanout - 1) - at)
    return F.struct(joined(left).alias("left"), joined(right).alias("right"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(proof, leaf, lambda own, level: digest(level["left"], own, level["right"]))


def proof_text(proof: Column) -> Column:
    return joined(F.transform(proof, lambda level: F.concat(level["left"], level["right"])))


def run_digests(digests: Column, fanout: int) -> Column:
    """The hash of every run of ``fanout`` digests; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda r: F.sha2(joined(F.slice(digests, r * fanout + 1, F.lit(fanout))), 256))


def block_table(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per block of ``fanout ** levels`` leaves of a tree: its members, and the digests of every level.

    ``leaves`` has tree, place and any further columns, among them leaf; d1, d2, ... are the levels
    above, the last a single digest. A block with room left at place 0 is a whole tree, which ends at the
    level that leaves one node; in any other block every level is taken, a run of one node included.
    """
    unit = fanout**levels
    others = [c for c in leaves.columns if c not in ("tree", "place")]
    members = F.sort_array(F.collect_list(F.struct("place", *others)))
    blocks = leaves.groupBy("tree", F.expr(f"place DIV {unit}").alias("block")).agg(members.alias("members"))
    for k in range(levels):
        below = _level(k)
        above = F.when(_is_taken(k, fanout, levels), run_digests(below, fanout)).otherwise(below)
        blocks = blocks.withColumn(f"d{k + 1}", above)
    return blocks


def _level(k: int) -> Column:
    return F.col(f"d{k}") if k else F.transform("members", lambda m: m["leaf"])


def _is_taken(k: int, fanout: int, levels: int) -> Column:
    """Whether a block's nodes of level ``k`` are hashed in runs, or are one node, the tree's last."""
    size = F.size("members")
    alone = (F.col("block") == 0) & (size < fanout**levels)
    return ~alone | (size > fanout**k)


def with_proofs(blocks: DataFrame, fanout: int, levels: int, above: list[str]) -> DataFrame:
    """The leaves of blocks, each with its siblings up to the block's node and those of ``above``."""
    others = [f.name for f in blocks.schema["members"].dataType.elementType.fields if f.name != "place"]
    blocks = blocks.withColumn("d0", _level(0))

    def with_proof(member: Column, i: Column) -> Column:
        parts = []
        for k in range(levels):
            index = F.floor(i / fanout**k).cast("int")
            level = siblings(F.col(f"d{k}"), index, fanout)
            parts.append(F.when(_is_taken(k, fanout, levels), level))
        proof = F.concat(F.array_compact(F.array(*parts)), *above)
        return F.struct(*(member[c].alias(c) for c in others), proof.alias("proof"))

    rows = blocks.select("tree", "subroot", "root", F.explode(F.transform("members", with_proof)).alias("m"))
    return rows.select("tree", *(f"m.{c}" for c in others), "subroot", "root", "m.proof")


def spread(nodes: DataFrame, per_tree: DataFrame) -> DataFrame:
    """Joins (tree, place) with the row of its tree; a large tree's row goes out under many keys."""
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least("nodes", F.lit(SALTS)) - 1)).alias("salt")
    copies = per_tree.select("*", salts)
    return nodes.withColumn("salt", F.col("place") % SALTS).join(copies, ["tree", "salt"]).drop("salt")


def butterfly(nodes: DataFrame, purpose: str, fanout: int = FANOUT) -> DataFrame:
    """For nodes (tree, place, digest) of many trees: tree, place, nodes, root, and the proof of each.

    In round r the nodes whose places differ in digit r alone, ``fanout`` of them at most, swap what
    they hold: the digest of the ancestor that r rounds of ``fanout ** r`` nodes have in common. Each
    of them hashes the next ancestor for itself and keeps the others' digests as its proof. After
    log(nodes) rounds every node has the root and its whole proof, and nothing travels downward.
    A tree's last subtree may be short: its nodes then speak for the missing ones too, in turn.

    A round is one shuffle of a row per node. Places count from 0 without gaps in each tree.
    """
    nodes = materialize(nodes.select("tree", "place", "digest"), f"{purpose}-nodes")
    per_tree = nodes.groupBy("tree").agg((F.max("place") + 1).alias("nodes"))
    most = per_tree.agg(F.max("nodes")).first()[0] or 1
    proof = "array<struct<left:string,right:string>>"
    state = spread(nodes, per_tree).withColumn("proof", F.array().cast(proof))
    step = 1
    while step < most:
        state = _exchange(state, step, fanout)
        step *= fanout
    return materialize(state.withColumnRenamed("digest", "root"), purpose)


def _exchange(state: DataFrame, step: int, fanout: int) -> DataFrame:
    """One round: nodes hold ancestors of ``step`` nodes and get those of ``step * fanout``."""
    ancestor = F.expr(f"place DIV {step}")
    last = F.expr(f"(nodes - 1) DIV {step}")
    low = F.col("place") % step
    present = F.col("nodes") - last * step  # nodes below the tree's last ancestor
    speaks = (F.col("ancestor") == last) & (present < step) & (F.col("ancestor") % fanout > 0)
    lows = F.when(
        speaks, F.sequence(low, F.lit(step - 1).cast("bigint"), F.greatest(present, F.lit(1)))
    ).otherwise(F.array(low))
    own = F.when(F.col("low") == low, F.struct("place", "proof"))
    sent = state.withColumn("ancestor", ancestor).withColumn("low", F.explode(lows)).select(
        "tree",
        "nodes",
        F.expr(f"ancestor DIV {fanout}").alias("parent"),
        "low",
        F.struct((F.col("ancestor") % fanout).alias("digit"), "digest", own.alias("own")).alias("said"),
    )
    heard = sent.groupBy("tree", "nodes", "parent", "low").agg(F.sort_array(F.collect_list("said")).alias("said"))
    digests = F.transform("said", lambda s: s["digest"])
    # A tree that is down to its root stays as it is.
    done = F.col("nodes") <= step

    def next_state(s: Column, i: Column) -> Column:
        level = siblings(F.col("digests"), i, fanout)
        proof = F.when(done, s["own"]["proof"]).otherwise(F.concat(s["own"]["proof"], F.array(level)))
        return F.when(s["own"].isNotNull(), F.struct(s["own"]["place"].alias("place"), proof.alias("proof")))

    return (
        heard.withColumn("digests", digests)
        .withColumn("above", F.when(done, F.element_at("digests", 1)).otherwise(F.sha2(joined(F.col("digests")), 256)))
        .select("tree", "nodes", "above", F.explode(F.array_compact(F.transform("said", next_state))).alias("s"))
        .select("tree", "nodes", "s.place", F.col("above").alias("digest"), "s.proof")
    )


def merkle_proofs(
    leaves: DataFrame, order: list[str], fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """The rows of ``leaves`` (tree, leaf, ...) with subroot, root and proof.

    Per tree, leaves stand in the given order, equal ones by their digest. While several nodes
    remain, every ``fanout`` consecutive ones become the hash of their digests as hex text, a last
    run of fewer, even of one, included. What remains is the subroot. Subroots in the order of
    their trees make the root in the same way. A proof has a (left, right) pair per level: the
    digests beside the own one in its run.

    Leaves are ranked by ranges and prefix sums, so a tree with a third of all rows spans many
    tasks. Blocks of ``fanout ** block_levels`` leaves are hashed where their leaves meet; from
    there on only a row per block travels, through ``butterfly``, and once more a row per tree.
    """
    placed = ranked(leaves, ["tree"], [*order, "leaf"], "merkle-ranks").withColumnRenamed("rank", "place")
    blocks = materialize(block_table(placed, fanout, block_levels), "merkle-blocks")
    node = F.element_at(_level(block_levels), 1).alias("digest")
    upper = butterfly(blocks.select("tree", F.col("block").alias("place"), node), "merkle-upper", fanout)
    subroots = upper.where("place = 0").select("tree", "nodes", F.col("root").alias("digest"))
    ordered = ranked(subroots.withColumn("all", F.lit(0)), ["all"], ["tree"], "merkle-trees")
    ordered = materialize(ordered, "merkle-ordered")
    top = butterfly(
        ordered.select(F.lit("").alias("tree"), F.col("rank").alias("place"), "digest"), "merkle-top", fanout
    )
    per_tree = ordered.join(
        top.select(F.col("place").alias("rank"), "root", F.col("proof").alias("top_proof")), "rank"
    ).select("tree", "nodes", "root", "top_proof")
    upper = upper.select("tree", "place", F.col("root").alias("subroot"), F.col("proof").alias("upper"))
    above = spread(upper, per_tree).select(
        "tree", F.col("place").alias("block"), "subroot", "root", "upper", "top_proof"
    )
    whole = blocks.join(above, ["tree", "block"])
    return with_proofs(whole, fanout, block_levels, ["upper", "top_proof"])


def dataset_manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """The manifest of a table of documents: doc_id, leaf, changed_leaf, subroot, root, proof; a row each.

    A leaf is the SHA-256 of ``FIELDS``, each as its byte count and value, a dash if null. With
    ``altered`` (a text) changed_leaf is the leaf of the row with that text, null where it is the
    same text. Within a source leaves go by doc_id, null first.

    A null source is a source. Rows with equal doc_ids are leaves of their own, by their digest;
    equal rows have equal leaves. An empty table gives no rows. Other columns play no part.
    """
    values = [counted(F.col(c)) for c in FIELDS]
    changed = F.lit(None).cast("string")
    if altered is not None:
        other = digest(*values[:-1], counted(altered))
        changed = F.when(~altered.eqNullSafe(F.col("text")), other)
    leaves = docs.select(
        tree_key(F.col("source")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        digest(*values).alias("leaf"),
        changed.alias("changed_leaf"),
    )
    # Written once, since ranges are sampled before rows are dealt by them.
    leaves = materialize(leaves, "merkle-leaves")
    return merkle_proofs(leaves, ["doc_id"]).drop("tree")


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest checked against a copy whose texts are in lower case (A-Z) in every fifth document.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. The fifth are those
    whose crc32 of the decimal doc_id 5 divides; a null doc_id is not among them. See
    ``dataset_manifest`` for nulls and repeated rows.
    """
    fifth = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    tampered = F.when(fifth, F.translate("text", CAPITALS, CAPITALS.lower())).otherwise(F.col("text"))
    manifest = dataset_manifest(docs, tampered)
    found = manifest.withColumn("folded_root", folded(F.coalesce("changed_leaf", "leaf"), F.col("proof")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: The same as SQL: levels of all trees by recursion, then proofs and roots from them.
MERKLE_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS tree, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT,
           flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                                  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda acc, x: xor(xor(acc, x) >> 1, (xor(acc, x) & 1) * 3988292384)), 4294967295) END AS crc
  FROM documents),
leaves AS (
  SELECT id, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
  FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, level, place // 16, n),
subroots AS (
  SELECT tree, digest AS subroot, level AS height,
         row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, place, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, place // 16, n),
low_proofs AS (
  SELECT p.id, o.level,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < p.place >> (4 * o.level)), '') AS l,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > p.place >> (4 * o.level)), '') AS r
  FROM placed p JOIN nodes o ON o.tree = p.tree AND o.n > 1 AND o.place >> 4 = p.place >> (4 * o.level + 4)
  GROUP BY p.id, o.level),
top_proofs AS (
  SELECT s.tree, s.height + o.level AS level,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < s.place >> (4 * o.level)), '') AS l,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > s.place >> (4 * o.level)), '') AS r
  FROM subroots s JOIN tops o ON o.n > 1 AND o.place >> 4 = s.place >> (4 * o.level + 4)
  GROUP BY s.tree, s.height, o.level),
proofs AS (
  SELECT * FROM low_proofs
  UNION ALL SELECT p.id, t.level, t.l, t.r FROM placed p JOIN top_proofs t ON t.tree = p.tree),
texts AS (
  SELECT id, string_agg(l || r, '' ORDER BY level) AS proof, count(*) AS height FROM proofs GROUP BY id),
folds AS (
  SELECT id, 0 AS level, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.id, f.level + 1, sha256(p.l || f.digest || p.r)
  FROM folds f JOIN proofs p ON p.id = f.id AND p.level = f.level)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(coalesce(x.proof, '')) AS proof_sha256,
       f.digest AS folded_root, f.digest = t.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN tops t ON t.n = 1
     LEFT JOIN texts x ON x.id = p.id JOIN folds f ON f.id = p.id AND f.level = coalesce(x.height, 0)
"""
