"""Benchmark passages inside long documents, by size-partitioned MinHash containment and an exact check.

Items are partitioned by size: class u holds those with up to u shingles and more than u / 2, u a power of two.  For each class a
document is cut into blocks of u shingles, and every two neighbouring blocks make a window, so that any run of u
shingles lies in a window whose size is known beforehand.  A containment of 0.8 then is a Jaccard similarity of about
0.2 or more whatever the length of the document, and of ``PERMUTATIONS`` minima some one is equal for practically all
such windows.  Items of class ``FEW`` have no windows: a document that holds enough of one's n shingles holds one of any
n - ceil(0.8 n) + 1 of them, so that many are its signatures and are looked up as they are.  Pairs found are kept if the
shingles of the item that occur anywhere in the document are enough.

Two bitmaps of 2 MB, one of the items' minima and one of their shingles, go to all workers whatever the benchmark's
size; they only keep back what cannot match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import importable
from tideline.llm.text import ALPHANUMERIC, Chunk, chunks, mix
from tideline.session import stage

WORDS = 5
CONTAINMENT = 0.8
PERMUTATIONS = 32
FEW = 8
"""Items of so many shingles or fewer, and those that mostly repeat themselves, are class ``FEW`` and found exactly."""
BITMAP_LOG = 24
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(PERMUTATIONS)], dtype=np.uint64)


def _size_class(n: int) -> int:
    return max(FEW, 1 << (int(n) - 1).bit_length()) if n else 0


def _signature(minima: np.ndarray, k: int, u: int) -> np.ndarray:
    """One number for (class, permutation, minimum)."""
    return mix(minima ^ np.uint64((u << 8 | k) * 0xA0761D6478BD642F % (1 << 64)))


def _minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each permutation, the minimum of each run that begins at ``starts``."""
    out = np.empty((PERMUTATIONS, len(starts)), dtype=np.uint64)
    for k, factor in enumerate(_FACTORS):
        out[k] = np.minimum.reduceat(h * factor ^ (h >> np.uint64(k + 1)), starts)
    return out


def _few_signatures(own: np.ndarray, containment: float) -> np.ndarray:
    """Signatures of an item of few different shingles; at least one occurs in every text with so much of the item."""
    wanted = max(1, int(np.ceil(len(own) * containment - 1e-9)))
    return _signature(own[: len(own) - wanted + 1], 0, FEW)


def _runs(counts: np.ndarray, u: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, number for each text) of runs of ``u``, the last of a text perhaps shorter."""
    many = -(-counts // u)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(first, many) + nth * u, many


def window_signatures(h: np.ndarray, counts: np.ndarray, classes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, signature) of all shingles, if there are items of few, and all windows of texts that have ``counts`` of the shingles ``h``."""
    if FEW in classes:
        yield np.repeat(np.arange(len(counts)), counts), _signature(h, 0, FEW)
    classes = [u for u in classes if u > FEW]
    if not classes:
        return
    least = min(classes)
    starts, many = _runs(counts, least)
    if not len(starts):
        return
    minima, u = _minima(h, starts), least
    while True:
        if u in classes:
            text = np.repeat(np.arange(len(many)), many)
            last = np.ones(len(text), dtype=bool)
            last[:-1] = text[1:] != text[:-1]
            window = minima.copy()
            at = np.flatnonzero(~last)
            window[:, at] = np.minimum(minima[:, at], minima[:, at + 1])
            for k in range(PERMUTATIONS):
                yield text, _signature(window[k], k, u)
        if u >= max(classes):
            return
        starts, more = _runs(many, 2)
        minima, many, u = np.minimum.reduceat(minima, starts, axis=1), more, 2 * u


def _spot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITMAP_LOG)).astype(np.int64)


def in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _spot(h)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(items: DataFrame, column: str) -> np.ndarray:
    """The bits of all numbers in an array column: at most 2^18 words come to the driver."""
    bits = items.select(F.explode(column).alias("h")).select(F.shiftrightunsigned("h", 64 - BITMAP_LOG).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    words = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_LOG - 6), dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint8)


def _shingled(column: pa.Array, words: int) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray]]:
    for chunk in chunks(pc.utf8_lower(column), ALPHANUMERIC):
        h, text, _ = chunk.shingles(words)
        yield chunk, h, np.bincount(text, minlength=chunk.size)


def item_table(items: DataFrame, words: int, containment: float, id_col: str, text_col: str) -> DataFrame:
    """(item, id, size, class, shingles, signatures): one row per item that has a word."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for chunk, h, counts in _shingled(batch.column(1), words):
                rows = []
                ends = np.cumsum(counts)
                for k, (end, n) in enumerate(zip(ends, counts, strict=True)):
                    if n:
                        own = np.unique(h[end - n : end])
                        u = _size_class(n)
                        if 2 * len(own) <= u:  # repeated shingles: a small part of any window
                            u = FEW
                        if u == FEW:
                            sig = _few_signatures(own, containment).view(np.int64)
                        else:
                            minima = _minima(own, np.zeros(1, dtype=np.int64))[:, 0]
                            sig = [int(_signature(minima[p : p + 1], p, u).view(np.int64)[0]) for p in range(PERMUTATIONS)]
                        rows.append((number + k, chunk.first + k, len(own), u, own.view(np.int64), sig))
                number += chunk.size
                if rows:
                    item, at, size, u, own, sig = zip(*rows, strict=True)
                    lists = [pa.array(x, pa.list_(pa.int64())) for x in (own, sig)]
                    arrays = [pa.array(item), batch.column(0).take(pa.array(at)), pa.array(size, pa.int64()), pa.array(u, pa.int64()), *lists]
                    yield pa.RecordBatch.from_arrays(arrays, names=["item", "id", "size", "class", "shingles", "signatures"])

    importable(items.sparkSession)
    schema = f"item bigint, id {kind}, size bigint, class bigint, shingles array<bigint>, signatures array<bigint>"
    return stage(items.select(id_col, text_col).mapInArrow(run, schema), "items")


def find(
    docs: DataFrame,
    items: DataFrame,
    words: int = WORDS,
    containment: float = CONTAINMENT,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    item_text_col: str | None = None,
) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment): a row for each document and item it contains, with columns ``keep`` of the document.

    Words are runs of letters, digits and characters beyond ASCII, lower-cased; texts of fewer words than a
    shingle have one, of all their words.  Items and texts that are null, empty or without a word match
    nothing.  Repeated documents are reported each for itself; items with equal ids count as one with the larger containment.
    """
    if doc_id == item_id:
        raise ValueError("the two id columns need different names")
    table = item_table(items, words, containment, item_id, item_text_col or text_col)
    classes = sorted(r["class"] for r in table.select("class").distinct().collect())  # powers of two
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((classes, bitmap(table, "signatures"), bitmap(table, "shingles")))
    named = [doc_id, *keep]
    kinds = [docs.schema[c].dataType.simpleString() for c in named]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, minima, known = shared.value
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for chunk, h, counts in _shingled(batch.column(0), words):
                text, sig = [], []
                for owner, s in window_signatures(h, counts, sizes) if sizes else ():
                    hit = np.flatnonzero(in_bitmap(minima, s))
                    text.append(owner[hit])
                    sig.append(s[hit])
                found = np.unique(np.concatenate(text)) if text else np.zeros(0, dtype=np.int64)
                if len(found):
                    text, sig = np.concatenate(text), np.concatenate(sig)
                    order = np.argsort(text, kind="stable")
                    text, sig = text[order], sig[order]
                    ends = np.cumsum(counts)
                    signatures, own = [], []
                    for t in found:
                        signatures.append(np.unique(sig[np.searchsorted(text, t) : np.searchsorted(text, t, side="right")]).view(np.int64))
                        mine = h[ends[t] - counts[t] : ends[t]]
                        own.append(np.unique(mine[in_bitmap(known, mine)]).view(np.int64))
                    lists = [pa.array(x, pa.list_(pa.int64())) for x in (own, signatures)]
                    rows = pa.array(found + chunk.first)
                    arrays = [pa.array(number + found), *(batch.column(k + 1).take(rows) for k in range(len(named))), *lists]
                    yield pa.RecordBatch.from_arrays(arrays, names=["row", *(f"c{k}" for k in range(len(named))), "own", "signatures"])
                number += chunk.size

    importable(spark)
    schema = ", ".join(["row bigint", *(f"c{k} {x}" for k, x in enumerate(kinds)), "own array<bigint>", "signatures array<bigint>"])
    hits = stage(docs.select(text_col, *named).mapInArrow(run, schema), "hits")
    candidates = hits.select("row", F.explode("signatures").alias("s")).join(table.select("item", F.explode("signatures").alias("s")), "s")
    pairs = candidates.select("row", "item").distinct().join(hits.drop("signatures"), "row").join(table.select("item", "id", "size", "shingles"), "item")
    common = F.size(F.array_intersect("shingles", "own")).cast("bigint")
    pairs = pairs.select("row", *(f"c{k}" for k in range(len(named))), F.col("id").alias("i"), "size", common.alias("shared"))
    pairs = pairs.where(F.col("shared") >= F.ceil(F.col("size") * containment - 1e-9))
    best = pairs.groupBy("row", *(f"c{k}" for k in range(len(named))), "i").agg(F.max(F.struct((F.col("shared") / F.col("size")).alias("c"), "shared", "size")).alias("b"))
    return best.select(
        *(F.col(f"c{k}").alias(c) for k, c in enumerate(named)),
        F.col("i").alias(item_id),
        F.col("b.shared").alias("shared"),
        F.col("b.size").alias("item_shingles"),
        F.col("b.c").alias("containment"),
    )


def oracle() -> str:
    """DuckDB SQL for ``find`` on ``documents`` and ``benchmark``: all shingles joined."""
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+')"
    shingles = f"""list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i : i + {WORDS - 1}], ' ')) END)"""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
b AS (SELECT row_number() OVER () AS k, item_id, {words} AS w FROM benchmark),
ds AS (SELECT r, doc_id, unnest({shingles}) AS s FROM d),
bs AS (SELECT k, item_id, len({shingles}) AS size, unnest({shingles}) AS s FROM b),
found AS (SELECT r, doc_id, item_id, k, size, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY ALL HAVING count(*) >= ceil(size * {CONTAINMENT} - 1e-9))
SELECT doc_id, item_id, shared, size AS item_shingles, shared / size AS containment FROM found
QUALIFY row_number() OVER (PARTITION BY r, item_id ORDER BY shared / size DESC, shared DESC) = 1"""
