"""Command line for spark-submit: `publish`, `layers`, `analytics`, `run`, `inspect`."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from invoicelake import contract
from invoicelake.plans import jobs
from invoicelake.plans.tables import TABLE_PATH, list_tables, open_tables, preview, row_counts
from invoicelake.sources.messages import KafkaTopic, MessageLog

# Failed files named on the screen; all of them are in the quarantine table.
SHOWN_FAILURES = 100

TABLES = (*contract.LAYER_TABLES, *contract.ANALYTICS_TABLES, contract.QUARANTINE)


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="invoicelake", description=__doc__)
    parser.add_argument("job", choices=("publish", "layers", "analytics", "run", "inspect"))
    parser.add_argument("--topic", help="topic to publish to and to read from")
    parser.add_argument("--bootstrap-servers", default="kafka:9092")
    parser.add_argument("--log-path", help="keep the topic as Parquet files here instead of in Kafka")
    parser.add_argument("--xml-dir", help="folder with the invoice XML files")
    parser.add_argument("--limit", type=int, help="publish only the first files in path order")
    parser.add_argument("--db", default="nfe", help="database of the layer tables")
    parser.add_argument("--table-path", help="shared folder of the tables, for a catalog that ends with the process")
    parser.add_argument("--quarantine-path", help="folder to which the list of unreadable files is added, too")
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    parser.add_argument("--strict", action="store_true", help="drop unreadable messages")
    args = parser.parse_args(argv)
    if args.job in ("publish", "layers", "run") and not args.topic:
        parser.error("--topic is required")
    if args.job in ("publish", "run") and not args.xml_dir:
        parser.error("--xml-dir is required")
    if args.limit is not None and args.limit < 0:
        parser.error("--limit must not be negative")
    return args


def inspect(spark: SparkSession, db: str) -> None:
    """Print the tables there are, the size of the first layers and some rows of the results."""
    found = list_tables(spark, db)
    print(*found, sep="\n")
    counted = tuple(t for t in (contract.BRONZE, contract.SILVER_HEADER, contract.SILVER_ITEM) if t in found)
    if counted:
        row_counts(spark, db, counted).show(truncate=False)
    for table in found:
        if table not in counted:
            print(table)
            preview(spark, db, table).show(truncate=False)


def main(argv: list[str]) -> int:
    args = arguments(argv)
    builder = SparkSession.builder.appName(f"invoicelake-{args.job}")
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    if args.log_path:
        topic = MessageLog(args.log_path, args.topic)
    else:
        topic = KafkaTopic(args.topic, args.bootstrap_servers)
    rows: dict[str, int] = {}
    if args.table_path:
        spark.conf.set(TABLE_PATH, args.table_path)
    if args.job != "publish":
        open_tables(spark, args.db, TABLES)
    try:
        if args.job in ("publish", "run"):
            summary = jobs.publish(spark, args.xml_dir, topic, args.limit, args.db)
            print(f"published: {summary.published}, failed: {summary.failed}")
            if summary.failed and args.quarantine_path:
                summary.quarantine.write.mode("append").parquet(args.quarantine_path)
                print(f"all failures: {args.quarantine_path}")
            if summary.failed > SHOWN_FAILURES:
                print(f"the first {SHOWN_FAILURES} of {summary.failed} failures; all are in the table "
                      f"{args.db}.{contract.QUARANTINE}:")
            for failed in summary.quarantine.orderBy("path").limit(SHOWN_FAILURES).collect():
                print(f"  {failed.path}: {failed.error}")
        if args.job in ("layers", "run"):
            rows = jobs.build_layers(spark, topic, args.db, args.strict)
            if not rows:
                print(f"no message in {args.topic}")
        if args.job == "analytics":
            rows = jobs.build_analytics(spark, args.db)
        if args.job == "inspect":
            inspect(spark, args.db)
    except jobs.NothingToPublish as nothing:
        print(nothing, file=sys.stderr)
        return 1
    for name, count in rows.items():
        print(f"{args.db}.{name}: {count}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
