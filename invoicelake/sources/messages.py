"""Message sources: a Kafka topic or a Parquet message log, both read as a bounded batch."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from invoicelake.contract import MESSAGE_LOG_SCHEMA
from invoicelake.plans.tables import staged
from invoicelake.sources import files

# Offsets of a publish: more than its messages. There is room for eight million publishes.
PUBLISH_OFFSETS = 1 << 40
_TASK_BITS = 33  # of Spark's increasing ids, those that count within a task


@dataclass(frozen=True)
class KafkaTopic:
    """A topic on a Kafka cluster; needs Spark's Kafka connector on the class path.

    A topic partition is by itself one task, however large. `min_partitions` lets Spark cut the
    larger ones into offset ranges; it defaults to the session's number of shuffle partitions.
    """

    topic: str
    bootstrap_servers: str = "kafka:9092"
    min_partitions: int | None = None

    def read_options(self, spark: SparkSession) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
            "minPartitions": str(
                self.min_partitions or spark.conf.get("spark.sql.shuffle.partitions")
            ),
        }

    def read(self, spark: SparkSession) -> DataFrame:
        """All messages from the topic's beginning to its end at the time of the read."""
        options = self.read_options(spark)
        return spark.read.format("kafka").options(**options, endingOffsets="latest").load()

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.read_options(spark)).load()

    def write(self, messages: DataFrame) -> None:
        """Publish (key, value) rows from the executors; the broker assigns offsets."""
        (
            messages.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.bootstrap_servers)
            .option("topic", self.topic)
            .save()
        )


@dataclass(frozen=True)
class MessageLog:
    """A topic kept as Parquet files with the columns of Spark's Kafka source.

    Topics lie in folders of their own, so reading one does not touch the others. Messages of one key
    share a partition. Offsets are unique and grow from one publish to the next; like a compacted topic's,
    they may have gaps.

    Every publish claims its range of offsets before it writes, by a file that only one publisher can
    make. So publishers at the same time share no offset, and none has to read the log.
    """

    path: str
    topic: str
    partitions: int = 4

    def read(self, spark: SparkSession) -> DataFrame:
        try:
            log = spark.read.schema(MESSAGE_LOG_SCHEMA).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            log = spark.createDataFrame([], MESSAGE_LOG_SCHEMA)
        return self._messages(log)

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return self._messages(spark.readStream.schema(MESSAGE_LOG_SCHEMA).parquet(self.path))

    def _messages(self, log: DataFrame) -> DataFrame:
        columns = T.StructType.fromDDL(MESSAGE_LOG_SCHEMA).names
        return log.where(F.col("topic") == self.topic).select(*columns)

    def write(self, messages: DataFrame) -> None:
        """Append (key, value) rows, numbered in the order of a copy that retries do not change."""
        spark = messages.sparkSession
        held = staged(messages.select(
            "key", "value", F.monotonically_increasing_id().alias("id")), f"messages_{self.topic}")
        task, place = F.shiftright("id", _TASK_BITS), F.col("id").bitwiseAND((1 << _TASK_BITS) - 1)
        # One row for each task that wrote the copy: how many messages the tasks before it wrote.
        earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        before = held.groupBy(task.alias("task")).agg(F.count("*").alias("n")).select(
            "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        claim = self._claim(spark)
        # In a folder of its own, as writers of one folder would remove each other's unfinished files.
        folder = f"{self.path.rstrip('/')}/topic={quote(self.topic)}/{claim:010d}"
        (
            held.withColumn("task", task).join(before, "task").select(
                F.pmod(F.hash("key"), F.lit(self.partitions)).alias("partition"),
                (F.lit(claim * PUBLISH_OFFSETS) + F.col("before") + place).alias("offset"),
                F.current_timestamp().alias("timestamp"),
                F.col("key").cast("binary").alias("key"),
                F.col("value").cast("binary").alias("value"),
            )
            .write.parquet(folder)
        )

    def _claim(self, spark: SparkSession) -> int:
        """The number of this publish, which no other one has."""
        folder = f"{self.path.rstrip('/')}/_claims/{quote(self.topic)}"
        claimed = files.names(spark, folder)
        if claimed:
            number = int(claimed[-1]) + 1
        else:  # none yet, or a log that was written without claims
            last = self.read(spark).agg(F.max("offset")).first()[0]
            number = 0 if last is None else last // PUBLISH_OFFSETS + 1
        while not files.create_once(spark, f"{folder}/{number:010d}"):
            number += 1
        return number
