"""Applying a change log to a table: route, fold, merge, insert and reject.

A log has ``topic, partition, offset, timestamp`` and a text ``value``.  A target
is ``(id, rec)`` with ``rec`` a MAP<STRING, STRING>; ``to_records`` and
``from_records`` convert a typed table.  In a patch a missing field means
"unchanged" and a NULL field means "cleared".
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.payload import flat_object, insert_id, last_values, operation, parse_error, parsed_record, record_id
from tideline.functions.timestamps import naive_utc
from tideline.specs import RAW_EXCERPT_CHARS

PATCH_TYPE = "map<string,string>"
LOG_ORDER = ("timestamp", "partition", "offset")


def route_topics(log: DataFrame, routes: DataFrame) -> DataFrame:
    """Messages with the ``table`` their topic is applied to; other topics are not read.

    ``routes`` is ``(topic, table)``; Spark broadcasts it when its size allows.
    """
    return log.join(routes.select("topic", "table"), "topic")


def parse_log(log: DataFrame, id_field: str) -> DataFrame:
    """The log with ``rec``, ``id``, ``operation`` and, for rejected values, ``error``.

    ``rec`` leaves out the identifier, which names the row and is not a change to it.
    Persist or stage the result before filtering it: Spark moves filters below the
    parsing and so parses twice.
    """
    return (
        log.withColumn("_flat", flat_object("value"))
        .withColumn("_raw", parsed_record("value", "_flat"))
        .withColumn("_rec", last_values("_raw"))
        .withColumn("id", record_id("value", "_rec", id_field, "_flat"))
        .withColumn("operation", operation("_rec", "id"))
        .withColumn("error", F.when(F.col("operation") == "reject", parse_error("value")))
        .withColumn("rec", F.map_filter("_rec", lambda k, v: k != id_field))
        .drop("_flat", "_raw", "_rec")
    )


def _position(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _exploded(records: DataFrame, *columns: str | Column) -> DataFrame:
    # the outer form keeps Spark from testing the map, and computing it once more, below the explode
    fields = records.select(*columns, F.explode_outer("rec").alias("field", "val"))
    return fields.where(F.col("field").isNotNull())


def by_fields(patches: DataFrame, order: Sequence[str]) -> DataFrame:
    """``(id, at, names, vals)``: each patch as one row, the fields it sets sorted by name.

    Of the patches of an id that set the same fields only the last counts, so they can be folded before they are cut into fields.
    """
    rows = patches.select("id", _position(order).alias("at"), F.sort_array(F.map_entries("rec")).alias("entries"))
    return rows.select("id", "at", F.col("entries.key").alias("names"), F.col("entries.value").alias("vals"))


def fields_of(rows: DataFrame, *columns: str) -> DataFrame:
    """One row a field of what ``by_fields`` gave, with ``columns`` beside it."""
    fields = rows.select(*columns, F.inline_outer(F.arrays_zip("names", "vals")).alias("field", "val"))
    return fields.where(F.col("field").isNotNull())


def fold_patches(
    patches: DataFrame, order: Sequence[str] = LOG_ORDER, fields: Sequence[str] = ()
) -> DataFrame:
    """One patch per ``id``: for each field the value set last in ``order``.

    First the last patch of each id and set of fields is found, one row a patch and
    combined within each map task, so that a shuffle carries at most one row per id,
    set of fields and task however often an id is patched.  Those left are shuffled by
    id alone and cut into fields there.  With ``fields`` named, that takes no row for
    each of them; other fields get rows of their own beside it, in the same pass.  The
    result is the same with and without ``fields``, but for ids whose patches set
    nothing: these are only kept with ``fields``.
    """
    last = by_fields(patches, order).groupBy("id", "names").agg(F.max_by("vals", "at").alias("vals"), F.max("at").alias("at"))
    last = last.repartition("id")
    if not fields:
        return (
            fields_of(last, "id", "at")
            .groupBy("id", "field")
            .agg(F.max_by("val", "at").alias("val"))
            .groupBy("id")
            .agg(F.map_from_entries(F.collect_list(F.struct("field", "val"))).alias("rec"))
        )
    patches = last.select("id", "at", F.map_from_arrays("names", "vals").alias("rec"))
    none = F.lit(None).cast("string")
    named = [F.when(F.map_contains_key("rec", F.lit(f)), F.struct(F.col("rec")[f].alias("val"))) for f in fields]
    whole = F.struct(none.alias("field"), none.alias("val"), *[v.alias(f"f{i}") for i, v in enumerate(named)])
    others = F.transform(
        F.filter(F.map_entries("rec"), lambda e: ~e["key"].isin(*fields)),
        lambda e: F.struct(
            e["key"].alias("field"),
            e["value"].alias("val"),
            *[F.lit(None).cast("struct<val: string>").alias(f"f{i}") for i in range(len(fields))],
        ),
    )
    rows = patches.select("id", "at", F.explode_outer(F.concat(F.array(whole), others)).alias("e"))
    latest = [F.max_by(F.col(f"e.f{i}"), F.when(F.col(f"e.f{i}").isNotNull(), F.col("at"))).alias(f"f{i}") for i in range(len(fields))]
    by_field = rows.groupBy("id", F.col("e.field").alias("field")).agg(F.max_by("e.val", "at").alias("val"), *latest)
    rest = F.collect_list(F.when(F.col("field").isNotNull(), F.struct(F.col("field").alias("key"), F.col("val").alias("value"))))
    whole = by_field.groupBy("id").agg(rest.alias("rest"), *[F.max(f"f{i}").alias(f"f{i}") for i in range(len(fields))])
    entries = [
        F.when(F.col(f"f{i}").isNotNull(), F.struct(F.lit(f).alias("key"), F.col(f"f{i}.val").alias("value")))
        for i, f in enumerate(fields)
    ]
    return whole.select(
        "id", F.map_from_entries(F.concat(F.filter(F.array(*entries), lambda e: e.isNotNull()), "rest")).alias("rec")
    )


def merged(rec: Column, patch: Column) -> Column:
    """``rec`` with the fields of ``patch``; ``rec`` itself where there is no patch."""
    untouched = F.map_filter(rec, lambda k, v: ~F.map_contains_key(patch, k))
    return F.when(patch.isNull(), rec).otherwise(F.map_concat(untouched, patch))


def merge_patches(target: DataFrame, folded: DataFrame) -> DataFrame:
    """Every target row, changed where a folded patch names it."""
    patch = folded.select("id", F.col("rec").alias("_patch"))
    return target.join(patch, "id", "left").select("id", merged(F.col("rec"), F.col("_patch")).alias("rec"))


def merge_columns(target: DataFrame, id_col: str, folded: DataFrame) -> DataFrame:
    """The same for a typed table: a patched field is cast to its column's type.

    A value that the type cannot hold becomes NULL; ``typed_updates`` finds such messages first.
    """
    patch = folded.select(F.col("id").alias("_id"), F.col("rec").alias("_patch"))
    joined = target.withColumn("_id", F.col(id_col).cast("string")).join(patch, "_id", "left")
    return joined.select(
        *[
            F.col(f.name)
            if f.name == id_col
            else F.when(F.map_contains_key("_patch", F.lit(f.name)), F.col("_patch")[f.name].try_cast(f.dataType))
            .otherwise(F.col(f.name))
            .alias(f.name)
            for f in target.schema.fields
        ]
    )


def typed_updates(updates: DataFrame, schema: T.StructType, id_col: str) -> DataFrame:
    """``updates`` with ``error`` for those that set a column of ``schema`` to what its type cannot hold.

    Such a message fails as a whole, like one to a record that does not exist: give those
    without error to ``fold_patches`` and ``merge_columns``, and the others to
    ``dead_letters``.  A field that the table does not have changes nothing and is no error.
    """
    wrong = [
        F.when(
            F.col("rec")[f.name].isNotNull() & F.col("rec")[f.name].try_cast(f.dataType).isNull(),
            F.concat(F.lit(f"{f.name} = "), F.substring(F.col("rec")[f.name], 1, RAW_EXCERPT_CHARS)),
        )
        for f in schema.fields
        if f.name != id_col
    ]
    listed = F.concat_ws(", ", *wrong)
    reason = F.concat(F.lit("updating record "), F.col("id"), F.lit(": no value of the column's type: "), listed)
    return updates.withColumn("error", F.when(listed != "", reason))


def new_rows(parsed: DataFrame) -> DataFrame:
    """Rows for messages without identifier, each with an id derived from its place in the log."""
    return parsed.where(F.col("operation") == "insert").select(
        insert_id("topic", "partition", "offset").alias("id"), "rec"
    )


def named_ids(updates: DataFrame) -> DataFrame:
    """Distinct ids of update messages; a hot id is one row per task before the shuffle."""
    return updates.select("id").distinct()


def unknown_ids(named: DataFrame, *known: DataFrame) -> DataFrame:
    """The ids of ``named`` that none of ``known`` holds.

    Each table is first reduced to the ids in question.  With ``named`` marked
    for broadcast the table is scanned without a shuffle, whatever its size.
    """
    for rows in known:
        held = rows.select("id").join(named, "id", "left_semi")
        named = named.join(held, "id", "left_anti")
    return named


def rejected_updates(updates: DataFrame, unknown: DataFrame) -> DataFrame:
    """Update messages whose id the target does not hold, with the reason."""
    reason = F.concat(F.lit("updating record "), F.col("id"), F.lit(": no such record"))
    return updates.join(unknown, "id", "left_semi").withColumn("error", reason)


def dead_letters(failed: DataFrame, table: str | None, now: datetime) -> DataFrame:
    """Failed messages with the reason and the processing time.

    ``table`` names the target; None keeps the ``table`` column of routed messages.
    """
    return failed.select(
        F.col("value").alias("original_payload"),
        "error",
        F.lit(naive_utc(now).strftime("%Y-%m-%dT%H:%M:%SZ")).alias("timestamp"),
        "topic",
        F.col("table") if table is None else F.lit(table).alias("table"),
        "partition",
        "offset",
    )


def to_records(df: DataFrame, id_col: str) -> DataFrame:
    """A typed table as ``(id, rec)``."""
    entries = []
    for f in df.schema.fields:
        if f.name != id_col:
            entries += [F.lit(f.name), F.col(f.name).cast("string")]
    return df.select(F.col(id_col).cast("string").alias("id"), F.create_map(*entries).cast(PATCH_TYPE).alias("rec"))


def from_records(records: DataFrame, schema: T.StructType, id_col: str) -> DataFrame:
    """``(id, rec)`` as a typed table; a missing field is NULL."""
    return records.select(
        *[(F.col("id") if f.name == id_col else F.col("rec")[f.name]).cast(f.dataType).alias(f.name) for f in schema]
    )


def record_fields(records: DataFrame, *more: str) -> DataFrame:
    """One row ``(id, field, val)`` per field; the columns ``more`` follow the id."""
    return _exploded(records, "id", *more)
