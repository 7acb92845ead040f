"""Where messages are published.  A sink's ``publish(messages, batch)`` either
writes every message or raises; publishing a file batch again replaces it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.timestamps import naive_utc
from tideline.operators.numbering import number_rows
from tideline.session import stage

# Durability and batching of the producer.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.compression.type": "snappy",
    "kafka.retries": "5",
    "kafka.delivery.timeout.ms": "30000",
    "kafka.request.timeout.ms": "20000",
    "kafka.max.request.size": "1048576",
}
MESSAGE_SCHEMA = (
    "key binary, value binary, headers array<struct<key: string, value: binary>>, partition int, offset bigint, "
    "timestamp timestamp_ntz, topic string, batch string"
)
MARK_SCHEMA = (
    "batch string, partition int, first bigint, next bigint, published timestamp_ntz, version bigint, slot int"
)
MARK_SLOTS = 8
DEFAULT_LOG_PARTITIONS = 8


class FileLog:
    """Parquet files by topic and batch, in which every message has a place: topic, partition and offset.

    A key decides on the partition, and a batch takes the next offsets of each of its partitions, in the order of its rows.  These are
    reserved before the files are written, so a batch that is published again, after a failure or by mistake, takes the same
    places and the same time of publishing and replaces its files.  One that was never written again leaves a gap.

    Reservations are kept by topic, of the last few batches and each with the state of all partitions, so they do not grow with the log.  A
    topic has one publisher at a time; several topics may be published side by side.
    """

    takes_order = True

    def __init__(
        self,
        path: str,
        partitions: int = DEFAULT_LOG_PARTITIONS,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    ):
        self.path = path
        self.partitions = partitions
        self._clock = clock

    def marks(self, topic: str) -> str:
        """The folder with the reservations of a topic; topics do not share one, as their publishers do not wait for each other."""
        return f"{self.path}/_marks/{hashlib.md5(topic.encode()).hexdigest()}"

    def publish(self, messages: DataFrame, batch: str) -> None:
        """Write ``messages``; a column ``order`` gives their order, else it is that of key and value.

        They are staged first: numbering reads them twice, and what they are read from may change or be counted on the way.
        """
        digest = F.md5(F.coalesce("key", "value", F.lit("").cast("binary")))
        partition = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % self.partitions).cast("int")
        rows = stage(messages.withColumn("partition", partition), "publish")
        order = [F.col(c) for c in ("topic", "partition", "order", "key", "value") if c in rows.columns]
        numbered = number_rows(rows, order, [c for c in rows.columns if c != "order"])
        sizes = numbered.groupBy("topic", "partition").agg(F.min("row_no").alias("low"), F.count("*").alias("n"))
        sizes = sizes.collect()  # a row for each partition of each topic in the batch
        spark = rows.sparkSession
        starts = []
        for topic in sorted({r["topic"] for r in sizes}):
            own = {r["partition"]: r["n"] for r in sizes if r["topic"] == topic}
            first, published = self._reserve(spark, topic, own, batch)
            starts += [
                (topic, r["partition"], first[r["partition"]] - r["low"], published) for r in sizes if r["topic"] == topic
            ]
        places = spark.createDataFrame(starts, "topic string, partition int, shift bigint, timestamp timestamp_ntz")
        placed = numbered.join(F.broadcast(places), ["topic", "partition"])
        (
            placed.withColumn("offset", F.col("shift") + F.col("row_no"))
            .withColumn("batch", F.lit(batch))
            .drop("shift", "row_no")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "batch")
            .parquet(self.path)
        )

    def _reserve(
        self, spark: SparkSession, topic: str, sizes: Mapping[int, int], batch: str
    ) -> tuple[dict[int, int], datetime]:
        """The first offset of ``batch`` in each of its partitions, and when it is published.

        A batch that has places keeps them if it still fits: it has grown into no other's, or is the last of its topic.
        """
        try:
            marks = spark.read.schema(MARK_SCHEMA).parquet(self.marks(topic)).collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            marks = []
        newest = max((m["version"] for m in marks), default=0)
        next_free = {m["partition"]: m["next"] for m in marks if m["version"] == newest}
        mine = max((m["version"] for m in marks if m["batch"] == batch), default=None)
        held = {m["partition"]: m for m in marks if m["version"] == mine}
        published = next((m["published"] for m in held.values()), naive_utc(self._clock()))
        if mine is not None:
            first = {p: held[p]["first"] if p in held else 0 for p in sizes}
            ends = {p: first[p] + n for p, n in sizes.items()}
            if all(p in held and ends[p] <= held[p]["next"] for p in sizes):
                return first, published
            if mine == newest:
                self._mark(spark, topic, batch, newest + 1, first, next_free | ends, published)
                return first, published
            published = naive_utc(self._clock())
        first = {p: next_free.get(p, 0) for p in sizes}
        ends = {p: first[p] + n for p, n in sizes.items()}
        self._mark(spark, topic, batch, newest + 1, first, next_free | ends, published)
        return first, published

    def _mark(
        self, spark: SparkSession, topic: str, batch: str, version: int, first: dict, next_free: dict, published: datetime
    ) -> None:
        rows = [
            (batch, p, first.get(p, end), end, published, version, version % MARK_SLOTS)
            for p, end in sorted(next_free.items())
        ]
        (
            spark.createDataFrame(rows, MARK_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot")
            .parquet(self.marks(topic))
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MESSAGE_SCHEMA).parquet(self.path)


class KafkaLog:
    """Kafka topics; needs Spark's Kafka connector."""

    def __init__(self, servers: str, **extra: str):
        self.options = {
            "kafka.bootstrap.servers": servers,
            "includeHeaders": "true",
            **PRODUCER_OPTIONS,
            **extra,
        }

    def publish(self, messages: DataFrame, batch: str) -> None:
        messages.write.format("kafka").options(**self.options).save()
