"""Totals kept between runs: the state of an append-only table's aggregates, merged with new files.

A state holds, for each group, exact partial sums that can be added (`functions/sums.py`), and the
names of the table's files that are in it. A later run aggregates only the files that are not, merges
the result with the state and writes that as the next version. A version counts once it carries its
mark, so a run that fails leaves the one before, and the next run takes the same files again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from invoicelake.operators.gold import Totals
from invoicelake.sources import files

_FILES = "files"
_MARK = "_WHOLE"


def _whole_versions(spark: SparkSession, folder: str) -> list[int]:
    return [int(n) for n in files.names(spark, folder) if files.exists(spark, f"{folder}/{n}/{_MARK}")]


def updated_totals(
    spark: SparkSession, table: str, wanted: tuple[Totals, ...], folder: str
) -> list[DataFrame]:
    """The gold rows of each of `wanted` over all rows of `table`, in one pass over its new files.

    States lie in `folder`, which must be shared and belong to this table and these totals. If files that
    are in the state have gone from the table, as after a rebuild, all its files are aggregated anew.
    The list of files is held by the driver, as in any read of the table.
    """
    rows = spark.table(table)
    current = set(rows.inputFiles())
    whole = _whole_versions(spark, folder)
    last = f"{folder}/{whole[-1]:010d}" if whole else None
    covered = {r.file for r in spark.read.parquet(f"{last}/{_FILES}").collect()} if last else set()
    if not covered <= current:
        last, covered = None, set()
    new = sorted(current - covered)
    if new or last is None:
        version = whole[-1] + 1 if whole else 0
        last = _next_version(spark, rows, new, covered, wanted, last, f"{folder}/{version:010d}")
        for old in files.names(spark, folder):
            if int(old) < version - 1:
                files.remove(spark, f"{folder}/{old}")
    return [w.finished(spark.read.parquet(f"{last}/{i}")) for i, w in enumerate(wanted)]


def _next_version(
    spark: SparkSession, rows: DataFrame, new: list[str], covered: set[str],
    wanted: tuple[Totals, ...], last: str | None, path: str,
) -> str:
    files.remove(spark, path)  # of a run that was cut short
    added = spark.read.schema(rows.schema).parquet(*new) if new else rows.limit(0)
    for i, totals in enumerate(wanted):
        state = totals.partial(added)
        if last is not None:
            # The schema of the state, not that of the file: Parquet makes no column required.
            before = spark.read.schema(state.schema).parquet(f"{last}/{i}")
            state = totals.merged(before.unionByName(state))
        state.write.parquet(f"{path}/{i}")
    held = [(file,) for file in sorted(covered | set(new))]
    spark.createDataFrame(held, "file string").write.parquet(f"{path}/{_FILES}")
    files.create_once(spark, f"{path}/{_MARK}")
    return path
