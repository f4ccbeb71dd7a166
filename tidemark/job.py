"""spark-submit entry point: bring one table to the state of a date.

    spark-submit --py-files tidemark.zip tidemark/job.py --feeds s3a://lake/conf/feeds.json \\
        --input-table orders --output-table sales.orders \\
        --output-root s3a://lake/sales/orders --processing-date 2024-03-01

The feeds file maps table names to the settings of `FeedSpec.from_dict`; Spark reads it, so it
may lie wherever the data may. The job needs a persistent catalog: a run starts from what the
catalog shows, and one kept in memory forgets every table when its session ends.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from functools import partial

from pyspark.sql import SparkSession

from tidemark import (
    FLAT,
    PARTITIONED,
    FeedSpec,
    RunOptions,
    RunReport,
    Target,
    run_logged,
    run_snapshot,
)
from tidemark.functions.dates import as_date
from tidemark.spec import MERGES


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--feeds", required=True, help="JSON file with the feed settings")
    parser.add_argument("--input-table", required=True, help="name of the feed in that file")
    parser.add_argument("--output-table", required=True, help="catalog table, or database.table")
    parser.add_argument("--output-root", required=True, help="folder of the table's data")
    parser.add_argument("--processing-date", required=True, type=as_date, help="YYYY-MM-DD")
    parser.add_argument("--partitioned", action="store_true", help="publish one date partition")
    parser.add_argument("--max-records-per-file", type=int)
    parser.add_argument("--format", default="parquet", help="format of the table's files")
    parser.add_argument("--merge", default="broadcast_delta", choices=MERGES)
    parser.add_argument("--count-rows", action="store_true", help="report rows the dates leave out")
    parser.add_argument("--check-columns", action="store_true", help="read file footers first")
    parser.add_argument("--ledger", action="store_true", help="skip files that earlier runs took in")
    parser.add_argument("--no-check-names", action="store_true", help="ignore odd file names")
    parser.add_argument("--buckets", type=int, help="bucket a flat table by its key")
    parser.add_argument("--run-log", help="folder to which a row about this run is appended")
    parser.add_argument("--null-policy", default="keep_old", choices=["keep_old", "overwrite"])
    parser.add_argument("--load-rank", default="first", choices=["first", "processing_date"])
    parser.add_argument("--bad-timestamp", default="fail", choices=["fail", "drop"])
    return parser.parse_args(argv)


def read_feed(spark: SparkSession, path: str, name: str) -> FeedSpec:
    feeds = json.loads(spark.read.text(path, wholetext=True).first().value)
    if name not in feeds:
        raise ValueError(f"{path} has no feed {name!r}, only {', '.join(sorted(feeds))}")
    return FeedSpec.from_dict(feeds[name])


def refuse_catalog_in_memory(spark: SparkSession) -> None:
    """A table published into such a catalog would be unknown to the next run."""
    own = spark.conf.get("spark.sql.catalog.spark_catalog", None)
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory" and not own:
        raise RuntimeError("the session's catalog is kept in memory; configure a persistent one")


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> RunReport:
    args = parse_args(argv)
    if spark is None:
        spark = SparkSession.builder.appName(args.output_table).enableHiveSupport().getOrCreate()
        refuse_catalog_in_memory(spark)
    spec = read_feed(spark, args.feeds, args.input_table)
    run = partial(run_logged, log=args.run_log) if args.run_log else run_snapshot
    return run(
        spark,
        spec,
        args.processing_date,
        Target(
            args.output_table,
            args.output_root,
            fmt=args.format,
            max_records_per_file=args.max_records_per_file,
            buckets=args.buckets,
        ),
        PARTITIONED if args.partitioned else FLAT,
        RunOptions(
            null_policy=args.null_policy,
            load_rank=args.load_rank,
            bad_timestamp=args.bad_timestamp,
            merge=args.merge,
            check_names=not args.no_check_names,
            check_columns=args.check_columns,
            ledger=args.ledger,
            count_rows=args.count_rows,
        ),
    )


if __name__ == "__main__":
    print(main())
