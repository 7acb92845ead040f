"""What every filter of a chain removes, for every order of the filters, from one pass over the documents.

A document is reduced to a mask of the filters that it fails.  Each mask is mapped to one wide integer that holds, for each of the 120
orders and 5 steps, a field for each thing that may happen there to such a document.  The integers of a part are summed, as often as
the part has documents of the mask, and the fields of the sum are the answer to all 600 steps.  A field is one bit wider than the
part's documents need, so no field runs into the next.  Documents are counted by mask and part before anything is dealt out
by part, so a part of any size is 128 rows.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.frames import importable

SPACES = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"
"""A: few words, B: few different words, C: many capitals, D: symbols, E: a text that an earlier document has."""
DUPLICATE = 1 << FILTERS.index("E")
ORDERS = list(itertools.permutations(range(len(FILTERS))))
STEPS = [(order, step) for order in ORDERS for step in range(len(order))]
OUTCOMES = ("kept", "removed", "redundant", "unique")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)


def outcome(mask: int, order: tuple[int, ...], step: int) -> set[str]:
    """What happens to a document of this mask at a step of an order."""
    fails = bool(mask >> order[step] & 1)
    gone = any(mask >> f & 1 for f in order[:step])
    return {
        name
        for name, holds in (
            ("kept", not fails and not gone),
            ("removed", fails and not gone),
            ("redundant", fails and gone),
            ("unique", mask == 1 << order[step]),
        )
        if holds
    }


def packed(mask: int, width: int) -> int:
    """All outcomes of a mask as one integer with a field of ``width`` bits each."""
    out = 0
    for k, (order, step) in enumerate(STEPS):
        for name in outcome(mask, order, step):
            out |= 1 << (width * (len(OUTCOMES) * k + OUTCOMES.index(name)))
    return out


def unpacked(total: int, width: int) -> list[dict[str, int]]:
    """The fields of a sum of packed integers, step by step."""
    data, ones = total, (1 << width) - 1
    size = width * len(OUTCOMES)
    blocks = [data >> (size * k) & ((1 << size) - 1) for k in range(len(STEPS))]
    return [{name: block >> (width * j) & ones for j, name in enumerate(OUTCOMES)} for block in blocks]


def audit_part(counts: list[tuple[int, bool, bool, int]]) -> list[tuple]:
    """(order, step, counts ...) of a part from its (mask, good, toxic, documents)."""
    width = sum(n for *_, n in counts).bit_length() + 1
    integers = {mask: packed(mask, width) for mask in {m for m, *_ in counts}}
    every = unpacked(sum(n * integers[m] for m, _, _, n in counts), width)
    good = unpacked(sum(n * integers[m] for m, is_good, _, n in counts if is_good), width)
    toxic = unpacked(sum(n * integers[m] for m, _, is_toxic, n in counts if is_toxic), width)
    shapley = dict.fromkeys(range(len(FILTERS)), 0)
    for (order, step), fields in zip(STEPS, every, strict=True):
        shapley[order[step]] += fields["removed"]
    out = []
    for (order, step), fields, g, t in zip(STEPS, every, good, toxic, strict=True):
        name = "".join(FILTERS[f] for f in order)
        out.append((name, step + 1, *fields.values(), g["removed"], t["removed"], shapley[order[step]]))
    return out


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of each part fail just these filters.

    The first four filters look at a text alone.  Equal texts are found by their SHA-256; of those the documents with the smallest
    id pass.  Copies are counted by task before they meet, so one text that a third of all documents have is a few rows.
    """
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed != "", F.split(trimmed, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), words.alias("words"))
    fails = (
        F.size("words") < 100,
        100 * F.size(F.array_distinct("words")) < 80 * F.size("words"),
        100 * (F.length("text") - F.length(F.translate("text", CAPITALS, ""))) > 10 * F.length("text"),
        F.col("text").rlike("[#$%&*|]"),
    )
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    read = read.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), mask.alias("mask"))
    read = read.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    flags = labels.where("quality = 1 OR toxic = 1").groupBy("doc_id")
    flags = flags.agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    flagged = read.join(flags, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    kinds = flagged.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("at_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
    )
    first = F.min("first").over(Window.partitionBy("digest"))
    kinds = kinds.withColumn("passing", F.col("unnamed") + F.when(F.col("first") == first, F.col("at_first")).otherwise(0))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
        F.struct((F.col("mask") + DUPLICATE).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
    )
    each = kinds.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*")
    return each.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n > 0")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows a part.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic; further columns are not read.  A null text is empty, a null
    language the part ''.  A document without an id is never a duplicate, nor is any other one of it.  Rows that repeat with
    one id count each; if that id is the smallest of its text, all of them pass.  Of several labels of a document one that
    is 1 is enough.  An empty table has no parts, so no rows.
    """

    def run(part: pa.Table) -> pa.Table:
        columns = [part[c].to_pylist() for c in ("mask", "good", "toxic", "n")]
        rows = audit_part(list(zip(*columns, strict=True)))
        names = ("filter_order", "step", *COUNTS)
        out = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
        kinds = {"filter_order": pa.string(), "step": pa.int32()}
        arrays = [pa.array(out[name], kinds.get(name, pa.int64())) for name in names]
        return pa.table([pa.array([part["part"][0].as_py()] * len(rows)), *arrays], names=["part", *names])

    importable(docs.sparkSession)
    counted = masks(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic"))
    return counted.groupBy("part").applyInArrow(run, SCHEMA)


def oracle() -> str:
    """SQL of the query: every order joined to the counts of masks."""
    letters = ", ".join(f"({k}, '{f}')" for k, f in enumerate(FILTERS))
    at = range(1, len(FILTERS) + 1)
    differ = " AND ".join(f"l{a}.f <> l{b}.f" for b in at for a in range(1, b))
    steps = "\n".join(
        f"        UNION ALL SELECT o, {s}, f{s}, {' + '.join(['0', *[f'(1 << f{e})' for e in range(1, s)]])} FROM orders" for s in at
    )
    return f"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ), flags AS (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), masks AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
            (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
            + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
            + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS mask
        FROM docs LEFT JOIN flags USING (doc_id)
    ), counts AS (
        SELECT part, good, toxic, mask, count(*) AS n FROM masks GROUP BY ALL
    ), letters AS (
        SELECT * FROM (VALUES {letters}) AS t(f, letter)
    ), orders AS (
        SELECT {" || ".join(f"l{k}.letter" for k in at)} AS o, {", ".join(f"l{k}.f AS f{k}" for k in at)}
        FROM {", ".join(f"letters l{k}" for k in at)} WHERE {differ}
    ), steps AS (
        SELECT '' AS o, 0 AS step, 0 AS f, 0 AS before WHERE false
{steps}
    ), summed AS (
        SELECT part, o AS filter_order, step, f,
            coalesce(sum(n) FILTER (mask & (before + (1 << f)) = 0), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (mask & (1 << f) > 0 AND mask & before = 0), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (mask & (1 << f) > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (mask = 1 << f), 0)::BIGINT AS unique_fails,
            coalesce(sum(n) FILTER (good AND mask & (1 << f) > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
            coalesce(sum(n) FILTER (toxic AND mask & (1 << f) > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
        FROM counts, steps GROUP BY ALL
    )
    SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM summed
    """
