"""Helpers of the text operators: tables in the shared folder, word patterns, row identity."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The characters that separate words in the contracts.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"
ALNUM_WORD = r"[a-zA-Z0-9\x{80}-\x{10FFFF}]+"  # the negated class is 20 times slower
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in `spark.checkpoint.dir`.

    Only where that is unset (local tests) it lies in the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    This cuts the lineage: what follows reads files that outlive executors. The folder belongs to
    the job, which removes it with the checkpoint folder.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """`df` written to the shared folder in buckets of `key`, and the name of its table.

    Joins on `key` then move only the other side. The caller drops the table when it is used up.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name), name


def words(text: Column) -> Column:
    """The words between blanks; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array())


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and all else as it is; only few texts need the slow translation."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return (
        F.when(ascii_only, F.lower(text)).when(F.lower(text) == text, text)
        .otherwise(F.translate(text, UPPER, LOWER))
    )


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def numbered(df: DataFrame, *kept: str) -> tuple[DataFrame, dict[str, str]]:
    """`df` with its columns called c0, c1, ... save for `kept`, and the new name of each.

    So no column of the user's can be taken for one that an operator makes. `restored` undoes it.
    """
    names = {c: c if c in kept else f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(names: dict[str, str]) -> list[Column]:
    return [F.col(new).alias(own) for own, new in names.items()]


def named_apart(df: DataFrame, *wanted: str) -> None:
    """Refuses a table that lacks a column that an operator reads."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")
