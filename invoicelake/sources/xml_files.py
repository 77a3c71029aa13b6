"""Directories of XML files as a DataFrame (path, content)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicelake.sources import files

# Spark counts each file as at least this many bytes when it packs files into tasks. Its default
# of 4 MB suits big files and gives a task some thirty; of invoices a task can take thousands.
_OPEN_COST = "spark.sql.files.openCostInBytes"
INVOICE_OPEN_COST = "64k"
FILES_PER_TASK, MAX_TASKS = 1000, 10_000  # of the files that Python workers read


@contextmanager
def packed_small_files(spark: SparkSession) -> Iterator[None]:
    """Read XML files in here with thousands of them per task; a setting of the user's own stays."""
    if _OPEN_COST in spark.conf.getAll or spark.sparkContext.getConf().contains(_OPEN_COST):
        yield
        return
    spark.conf.set(_OPEN_COST, INVOICE_OPEN_COST)
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_COST)


def xml_files(spark: SparkSession, xml_dir: str, limit: int | None = None) -> DataFrame:
    """All `*.xml` files below `xml_dir`; with `limit`, the first ones in path order.

    Spark packs the files into tasks, see `packed_small_files`; nothing is repartitioned here. Names
    that begin with a full stop are hidden. Those with an underscore Spark's scan leaves out; they are
    looked up beside it and read by `underscored_files`.
    """
    visible = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xml")
        .load(xml_dir)
    )
    left_out = underscored_paths(spark, xml_dir)
    if not limit:
        return _both(visible.select("path", "content"), left_out)
    # The last of the wanted files marks the end of both orders, that of the paths and that of
    # their encoded form. A predicate on _metadata prunes the listing, so files behind it stay shut.
    url = F.col("_metadata.file_path")
    paths = visible.select("path", url.alias("url"))
    if left_out:
        paths = paths.unionByName(spark.createDataFrame(
            [(path, None) for path in left_out], "path string, url string"))
    last = first_paths(paths, limit).agg(F.max("path").alias("path"), F.max("url").alias("url")).first()
    return _both(
        visible.where((url <= last.url) & (F.col("path") <= last.path)).select("path", "content"),
        # Spark orders strings by their UTF-8 bytes, which is the order of code points, as here.
        [path for path in left_out if path <= last.path])


def _both(visible: DataFrame, left_out: list[str]) -> DataFrame:
    return visible.unionByName(underscored_files(visible.sparkSession, left_out)) if left_out else visible


def underscored_paths(spark: SparkSession, xml_dir: str) -> list[str]:
    """Sorted paths of the `*.xml` files that Spark's file sources leave out.

    These are files with a name that begins with an underscore and has no equals sign, and files in such folders.
    Each depth is one look-up by the file system, of which only such names come to the driver.
    """
    found: set[str] = set()
    for root in files.glob(spark, xml_dir):
        depth = files.escaped(root)
        while files.glob(spark, f"{depth}/*"):
            for path in files.glob(spark, f"{depth}/_*"):
                found.update(files.below(spark, path, ".xml"))
            depth += "/*"
        skipped = len(root.rstrip("/")) + 1
        found = {path for path in found if not path.startswith(root) or _left_out(path[skipped:])}
    return sorted(found)


def _left_out(path: str) -> bool:
    names = path.split("/")
    return not any(n.startswith(".") for n in names) and any(
        n.startswith("_") and "=" not in n for n in names)


def underscored_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content) of files by name, read by Python workers, as Spark's own scan refuses them.

    A worker reads local paths and those of the file systems that Arrow knows. `content` is null where it
    cannot, and the file then counts as unreadable.
    """
    tasks = max(1, min(len(paths) // FILES_PER_TASK + 1, MAX_TASKS))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks, "path").mapInArrow(
        _contents, "path string, content binary")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One file at a time, whatever their number."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([path], pa.string()), pa.array([_content(path)], pa.binary())], ["path", "content"])


def _content(path: str) -> bytes | None:
    scheme, _, rest = path.partition(":")
    try:
        if scheme == "file":
            system, place = fs.LocalFileSystem(), f"/{rest.lstrip('/')}"
        else:
            system, place = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
        with system.open_input_stream(place, compression=None) as stream:
            return stream.read()
    except (OSError, pa.ArrowException):
        return None


def first_paths(files: DataFrame, limit: int) -> DataFrame:
    """The `limit` first rows in path order."""
    if limit < 0:
        raise ValueError(f"limit must not be negative: {limit}")
    return files.orderBy("path").limit(limit)


def limit_files(files: DataFrame, limit: int | None) -> DataFrame:
    """The files whose paths are the `limit` first ones; None or 0 keeps all.

    Only paths are sorted; the contents stay where they are until the semi-join.
    """
    if not limit:
        return files
    return files.join(first_paths(files.select("path"), limit), "path", "left_semi")
