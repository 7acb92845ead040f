"""Streams that keep state: a fold that runs on, and messages that come twice or too late.

State is Spark's own.  A running fold keeps it in RocksDB; for large state of the others set
``spark.sql.streaming.stateStore.providerClass`` to that provider.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.apply import LOG_ORDER, by_fields, fields_of, parse_log
from tideline.sinks.targets import write_batch

PLACE = ("topic", "partition", "offset")
FOLD_SCHEMA = (
    "id string, field string, val string, timestamp timestamp_ntz, partition int, offset bigint, source string, batch_id bigint"
)


STATE = "spark.sql.streaming.stateStore"
LARGE_STATE = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
}
"""State on local disk, of which a batch writes what it changed.  Spark's default keeps all state in memory and copies its index in each batch."""


@contextlib.contextmanager
def _large_state(spark: SparkSession) -> Iterator[None]:
    """``LARGE_STATE`` for the queries started meanwhile, where the session says nothing else; a query keeps the settings of its start."""
    added = [key for key in LARGE_STATE if key not in spark.conf.getAll]
    for key in added:
        spark.conf.set(key, LARGE_STATE[key])
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def _start(writer: Any, name: str, checkpoint: str, trigger: dict[str, Any] | None) -> StreamingQuery:
    return writer.queryName(name).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_fold(
    log: DataFrame, path: str, checkpoint: str, *, id_field: str, name: str = "fold", trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Fold the updates of a log as they come: each batch writes the fields that it may have changed.

    State holds the last patch of each id and set of fields, as ``fold_patches`` does before it cuts them: one row a patch is looked up, not
    one a field.  What a batch writes of a field may be older than what one before it wrote; ``read_fold`` takes the last by place.  A batch
    that is run again replaces its rows.
    """
    # no filter on the operation: Spark would move it below the parsing and parse twice; what is no update falls into one group without names
    updated = parse_log(log, id_field).withColumn("rec", F.when(F.col("operation") == "update", F.col("rec")))
    last = F.max(F.struct("at", "vals")).alias("last")
    folded = by_fields(updated, LOG_ORDER).groupBy("id", "names").agg(last).select("id", "names", "last.vals", "last.at")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(fields_of(batch, "id", "at").select("id", "field", "val", "at.*"), path, batch_id, name)

    with _large_state(log.sparkSession):
        return _start(folded.writeStream.outputMode("update").foreachBatch(write), f"fold-{name}", checkpoint, trigger)


def read_fold(spark: SparkSession, path: str) -> DataFrame:
    """``(id, rec)``: the patch of each id after all batches, as ``fold_patches`` of the whole log gives it."""
    rows = spark.read.schema(FOLD_SCHEMA).parquet(path)
    place = F.struct(*LOG_ORDER, "batch_id", "val")
    last = rows.groupBy("id", "field").agg(F.max(place)["val"].alias("val"))
    return last.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "val"))).alias("rec"))


def once(log: DataFrame, within: str, ts_col: str = "timestamp", keys: Sequence[str] = PLACE) -> DataFrame:
    """Each message of a stream once, however often and by whichever checkpoint it is delivered.

    ``within`` is an interval such as ``2 hours``: a message delivered again so much later by its own clock is known, and keys older
    than the newest time less ``within`` are forgotten, which bounds the state.  Messages behind that watermark are
    not passed on; ``late`` finds them.
    """
    # a watermark needs an instant; the text of the UTC clock with its zone is one in every session
    instant = F.concat(F.col(ts_col).cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")
    marked = log.withColumn("_instant", instant).withWatermark("_instant", within)
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_instant")


def stream_on_time(
    log: DataFrame, within: str, path: str, checkpoint: str, *, name: str = "on_time", trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Write each message that comes before the watermark once.  ``numRowsDroppedByWatermark`` of the query counts the others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, name)

    return _start(once(log, within).writeStream.outputMode("append").foreachBatch(write), f"once-{name}", checkpoint, trigger)


def read_on_time(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, source string, batch_id bigint").parquet(path).drop("source", "batch_id")


def late(log: DataFrame, on_time: DataFrame, keys: Sequence[str] = PLACE) -> DataFrame:
    """Messages of a delivered log that the watermark has left out, each once; they are kept, not lost.

    ``log`` must not be ahead of the stream.  Both sides are shuffled by place, which is unique to a message.
    """
    return log.dropDuplicates(list(keys)).join(on_time.select(*keys).distinct(), list(keys), "left_anti")
