"""Command line: ``python -m wattline SOURCE TARGET`` or the same under spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wattline.plans import run
from wattline.session import build_session
from wattline.sources import export_readings
from wattline.streaming import compact, read_enriched, refresh
from wattline.streaming import follow as refresh_again


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wattline", description=__doc__)
    parser.add_argument("source", help="file, folder or glob of delimited raw readings")
    parser.add_argument("target", help="folder for the result, or for the tier with --follow")
    parser.add_argument("--sep", default=";", help="delimiter of the source")
    parser.add_argument("--target-sep", default=",", help="delimiter of a csv target")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--timestamp-format", action="append", default=[], dest="formats")
    parser.add_argument("--strict", action="store_true", help="fail on a line with too many fields")
    parser.add_argument("--unordered", action="store_true", help="do not sort the target by time")
    parser.add_argument("--single-file", action="store_true", help="for small results")
    parser.add_argument("--missing", choices=["error", "empty"], default="error", help="what an absent source is")
    parser.add_argument("--work", help="shared folder for intermediate tables, which go after the run")
    parser.add_argument("--input-bytes", type=int, help="size of the source, in place of its listing")
    parser.add_argument("--follow", action="store_true", help="keep a tier up to date as files arrive, change and go")
    parser.add_argument("--every", default="5 minutes", help="refresh period of --follow")
    parser.add_argument("--columns", help="with --follow: header names, to save reading them")
    parser.add_argument("--export", help="with --follow: folder that gets the enriched tier after every batch")
    parser.add_argument("--compact", action="store_true", help="with --follow --once: merge the tier's parts at the end")
    parser.add_argument("--once", action="store_true", help="with --follow: refresh once, then stop")
    return parser.parse_args(arguments)


def follow(spark: SparkSession, options: argparse.Namespace) -> None:
    """Keep a tier, and a result if one is named, up to date with the files that are there."""

    def publish(session: SparkSession) -> None:
        export_readings(
            read_enriched(session, options.target),
            options.export,
            options.target_sep,
            format=options.format,
            ordered=not options.unordered,
            single_file=options.single_file,
        )

    settings = {
        "formats": options.formats,
        "columns": options.columns.split(options.sep) if options.columns else None,
        "strict": options.strict,
    }
    if options.once:
        if refresh(spark, options.source, options.target, options.sep, **settings) and options.export:
            publish(spark)
    else:
        after = publish if options.export else None
        query = refresh_again(
            spark, options.source, options.target, options.sep, every=options.every, after=after, **settings
        )
        query.awaitTermination()
    if options.compact:
        compact(spark, options.target)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = build_session(input_bytes=options.input_bytes)
    if options.follow:
        follow(spark, options)
        return
    report = run(
        spark,
        options.source,
        options.target,
        sep=options.sep,
        target_sep=options.target_sep,
        format=options.format,
        formats=options.formats,
        strict=options.strict,
        missing=options.missing,
        ordered=not options.unordered,
        single_file=options.single_file,
        work=options.work,
    )
    print(report)


if __name__ == "__main__":
    main()
