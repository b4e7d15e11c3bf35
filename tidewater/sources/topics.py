"""Topics behind one interface: a Kafka cluster, or Parquet folders with the same columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewater.schemas import TOPIC_ROW

# Identifies a message and orders the messages of one source.
ORDER_COLUMNS = ("timestamp", "partition", "offset")
MESSAGE_COLUMNS = ("topic", "key", "value", *ORDER_COLUMNS)


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster. Needs Spark's Kafka connector on the class path.

    Progress lives in the checkpoint of the query, so no consumer group is set.
    Credentials and limits come from ``options`` only.
    """

    servers: str
    options: Mapping[str, str] = field(default_factory=dict)

    def read_options(self, topics: str, starting: str, pattern: bool) -> dict[str, str]:
        subscribe = "subscribePattern" if pattern else "subscribe"
        return {
            "kafka.bootstrap.servers": self.servers,
            subscribe: topics,
            "startingOffsets": starting,
            **self.options,
        }

    def stream(
        self, spark: SparkSession, topics: str, starting: str = "latest", pattern: bool = False
    ) -> DataFrame:
        options = self.read_options(topics, starting, pattern)
        return _messages(spark.readStream.format("kafka").options(**options).load())

    def read(self, spark: SparkSession, topics: str, pattern: bool = False) -> DataFrame:
        options = self.read_options(topics, "earliest", pattern)
        return _messages(spark.read.format("kafka").options(**options).load())

    def write_stream(self, rows: DataFrame) -> DataStreamWriter:
        return rows.writeStream.format("kafka").options(**self._write_options())

    def write_batch(self, rows: DataFrame, batch_id: int, job: str = "batch") -> None:
        """At least once: a replayed batch repeats its messages under the same keys."""
        rows.write.format("kafka").options(**self._write_options()).save()

    def _write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **self.options}


@dataclass(frozen=True)
class FileTopics:
    """Topics as Parquet below ``root``, one ``topic=…`` folder each."""

    root: str
    max_files_per_trigger: int | None = None

    def stream(
        self, spark: SparkSession, topics: str, starting: str = "earliest", pattern: bool = False
    ) -> DataFrame:
        if starting != "earliest":
            raise ValueError("a file-backed topic can only be streamed from its first file")
        reader = spark.readStream.schema(f"{TOPIC_ROW}, topic string")
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return _file_messages(reader.parquet(self.root), topics, pattern)

    def read(self, spark: SparkSession, topics: str, pattern: bool = False) -> DataFrame:
        reader = spark.read.schema(f"{TOPIC_ROW}, topic string")
        return _file_messages(reader.parquet(self.root), topics, pattern)

    def write_stream(self, rows: DataFrame) -> DataStreamWriter:
        """Exactly once, by the file sink's own commit log."""
        return rows.writeStream.format("parquet").option("path", self.root).partitionBy("topic")

    def write_batch(self, rows: DataFrame, batch_id: int, job: str = "batch") -> None:
        """Exactly once: a replayed batch replaces its own folder, and no other job's.

        ``job`` must stay the same over restarts and differ between jobs that share a root.
        """
        target = f"{self.root}/job={job}/batch_id={batch_id}"
        rows.write.mode("overwrite").partitionBy("topic").parquet(target)


Topics = KafkaTopics | FileTopics


def without_repeats(rows: DataFrame) -> DataFrame:
    """Rows read from a topic whose sink may repeat messages: one per topic and key."""
    return rows.dropDuplicates(["topic", "key"])


def without_repeats_within(rows: DataFrame, within: str = "1 hour") -> DataFrame:
    """The same for a stream, for repeats that come at most ``within`` after the first in ``timestamp``.

    A key is forgotten when the stream has gone on for longer than that, so the state holds
    the messages of ``within`` and not of the topic. Choose it longer than a sink may take
    from its first try of a batch to the last.
    """
    return rows.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["topic", "key"])


def _messages(records: DataFrame) -> DataFrame:
    text = {name: F.col(name).cast("string") for name in ("key", "value")}
    return records.withColumns(text).select(*MESSAGE_COLUMNS)


def _file_messages(rows: DataFrame, topics: str, pattern: bool) -> DataFrame:
    wanted = F.col("topic").rlike(f"^(?:{topics})$") if pattern else F.col("topic").isin(topics.split(","))
    order = {
        "timestamp": F.col("_metadata.file_modification_time"),
        "partition": F.col("_metadata.file_path"),
        "offset": F.col("_metadata.row_index"),
    }
    return rows.where(wanted).withColumns(order).select(*MESSAGE_COLUMNS)
