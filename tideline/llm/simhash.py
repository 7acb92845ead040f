"""Near-duplicates by SimHash fingerprints, found through fuzzy keys from the Golay code.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  If two fingerprints differ in at
most four bits, some two neighbouring segments (of the cycle) differ in at most two bits together, and
either both in one or fewer, or only the first of them.  So a pair of codeword indices, 24 bits, is
a key they share:

* one bit each: (one of six of the left, the nearest of the other) and (the nearest, one of six);
* two bits in the first: one of the six of either, and the nearest of the second.

``exact_keys`` makes 18 keys to be found by and 33 to look for, with no loss up to 4 bits.

Links are found in two steps.  First every fingerprint is compared with the smallest one under each key; the
components of those links hold nearly all of a dense group.  Then fingerprints of different components
that share a key are compared.  So a group of thousands gives thousands of links, not millions, and
none between different components is missed.

``near_copies`` links the same way, but by min-hash keys and the exact similarity; the pipeline uses ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import contamination, golay
from tideline.llm.frames import map_batches
from tideline.llm.groups import components
from tideline.llm.text import LOWER, NOT_SPACE, Chunk, byte_runs, chunks, mix
from tideline.session import stage

SEED = 42
CUTS = ((0, 22), (22, 21), (43, 21))
HASHES_AT_ONCE = 1 << 16
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    total = np.zeros(64, dtype=np.int64)
    place = np.arange(8) * 256
    for lo in range(0, len(h), HASHES_AT_ONCE):
        part = h[lo : lo + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts = np.bincount((part + place).ravel(), minlength=2048).reshape(8, 256)
        total += (counts @ _BIT).ravel()
    return total


def fingerprint(h: np.ndarray) -> int:
    """Bit b is 1 if set in over half the hashes; zero for none."""
    set_bits = (2 * _bit_counts(h) > len(h)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in bounded pieces."""
    digest = xxhash.xxh64_intdigest
    for lo in range(0, max(1, len(words) - size + 1), HASHES_AT_ONCE):
        some = words[lo : lo + HASHES_AT_ONCE + size - 1]
        joined = b" ".join(some)
        ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1)
        starts = np.concatenate(([0], ends[:-1])).tolist()
        ends = (ends - 1).tolist()
        if len(some) < size:
            yield np.array([digest(joined, SEED)], dtype=np.uint64)
        else:
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)], dtype=np.uint64)


def fingerprints(column: pa.Array, words: int) -> np.ndarray:
    """The fingerprint of each text over its shingles of ``words`` words, repeats included."""
    out = []
    for _, data, offsets in byte_runs(column):
        low = LOWER[data].tobytes()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if not (found := low[a:b].split()):
                out.append(0)
                continue
            total, count = np.zeros(64, dtype=np.int64), 0
            for h in _shingle_hashes(found, words):
                total, count = total + _bit_counts(h), count + len(h)
            out.append(int(np.packbits((2 * total > count).astype(np.uint8), bitorder="little").view("<u8")[0]))
    return np.array(out, dtype=np.uint64)


def sign(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row per document.  A null or empty text, and one of white space, has fingerprint zero."""
    kind = docs.schema[id_col].dataType.simpleString()

    def build(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column(0), "fp": fingerprints(batch.column(1), words).view(np.int64)}

    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), f"id {kind}, fp bigint", build)


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    found = [golay.indices((fp >> np.uint64(at)) & np.uint64((1 << size) - 1)) for at, size in CUTS]
    return [x.astype(np.int64) for x in found]


def exact_keys(fp: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(keys, alternative), a row for each fingerprint; some keys of a row may be equal.

    A key is an alternative if its left index is not that of the nearest codeword.
    """
    parts, out, other = _segments(fp), [], []
    for k in range(3):
        left, right = parts[k], parts[(k + 1) % 3]
        out.append(k << 24 | left << 12 | right[:, :1])
        other.append(left != left[:, :1])
        if probe:
            out.append(k << 24 | left[:, :1] << 12 | right[:, 1:])
            other.append(np.zeros((len(fp), 5), dtype=bool))
    return np.concatenate(out, axis=1), np.concatenate(other, axis=1)


def keyed(classes: DataFrame, probe: bool) -> DataFrame:
    """The rows of ``classes`` (all bigint, with ``fp``), once for each different key."""
    names = classes.columns

    def build(batch: pa.RecordBatch) -> dict:
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        keys, other = exact_keys(columns["fp"].view(np.uint64), probe)
        found = np.sort(keys << 1 | other, axis=1)
        new = np.ones(found.shape, dtype=bool)
        new[:, 1:] = found[:, 1:] >> 1 != found[:, :-1] >> 1
        row = np.nonzero(new)[0]
        return {"key": found[new] >> 1, "alternative": (found[new] & 1).astype(bool), **{n: x[row] for n, x in columns.items()}}

    return map_batches(classes, ", ".join(["key bigint", "alternative boolean", *(f"{n} bigint" for n in names)]), build)


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select("key", *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "key"))


def _one_combination(a: str, b: str) -> Column:
    """Of the keys that a pair within reach must share, only the first counts: a pair is not given once for each."""
    differing = F.col(f"fp_{a}").bitwiseXOR(F.col(f"fp_{b}"))
    wrong = [F.bit_count(F.shiftrightunsigned(differing, at).bitwiseAND(F.lit((1 << size) - 1))) for at, size in CUTS]
    used = F.shiftright("key", 24)
    first = F
    for k in range(3):
        left, right = wrong[k], wrong[(k + 1) % 3]
        first = first.when((left <= 1) & (right <= 1), (used == k) & ~F.col(f"alternative_{b}"))
        first = first.when((left <= 2) & (right == 0), used == k)
    return first.otherwise(F.lit(True))


def link_components(
    classes: DataFrame,
    near: Callable[[str, str], Column],
) -> DataFrame:
    """(node, component) of classes: ``node`` unique, ``fp``, and what else ``near`` compares, all bigint.

    ``near`` gets the suffixes of the two sides' columns.  Nodes without a link are not returned.
    """
    columns = classes.columns
    lowest = keyed(classes, False).groupBy("key").agg(F.min(F.struct("node", *(c for c in columns if c != "node"))).alias("low"))
    lowest = lowest.select("key", *(F.col(f"low.{c}").alias(f"{c}_a") for c in columns))
    star = _side(keyed(classes, True), "b").join(lowest.hint("merge"), "key").where((F.col("node_a") != F.col("node_b")) & near("a", "b"))
    first = stage(components(star.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()), "groups")

    labelled = classes.join(first.withColumnRenamed("component", "label"), "node", "left")
    labelled = stage(labelled.withColumn("label", F.coalesce("label", "node")), "labelled")
    base, probe = _side(keyed(labelled, False), "a"), _side(keyed(labelled, True), "b")
    rest = probe.join(base.hint("merge"), "key").where((F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & near("a", "b") & _one_combination("a", "b"))
    pairs = rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    label = labelled.select("node", "label")
    across = pairs.join(label.toDF("a", "x"), "a").join(label.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    second = stage(components(across), "groups")
    joined = labelled.select("node", "label").join(second.toDF("label", "component"), "label", "left")
    return joined.select("node", F.coalesce("component", "label").alias("component"))


def within(distance: int) -> Callable[[str, str], Column]:
    return lambda a, b: F.bit_count(F.col(f"fp_{a}").bitwiseXOR(F.col(f"fp_{b}"))) <= distance


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per document.

    Fingerprints that differ in at most ``distance`` bits are linked; ``distance`` may be 0 to 4.
    component_id is the smallest id reachable by links, itself included.  Rows that repeat, and all texts
    with one fingerprint, are one class that is compared once.  A document whose id is null is kept; its
    component_id is the smallest id that is not null, or null.  Only the two columns named are read.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the keys find all pairs up to 4 bits only")
    signed = stage(sign(docs, words, id_col, text_col), "signed")
    classes = stage(signed.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    nodes = classes.select(F.col("fp").alias("node"), "fp")
    group = link_components(nodes, within(distance))
    group = stage(classes.withColumnRenamed("fp", "node").join(group, "node", "left").withColumn("component", F.coalesce("component", "node")), "groups")
    least = group.groupBy("component").agg(F.min("least").alias("component_id"))
    named = group.join(least, "component").select(F.col("node").alias("fp"), "component_id")
    return signed.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


SIMILARITY = 0.8
BANDS, BAND_ROWS = 32, 5
"""Keys of a text, and minima in each: two texts at 0.8 share no key three times in a million, since (1 - 0.8^5)^32 is 3e-6."""
SKETCH_WORDS = -(-BANDS * BAND_ROWS // 64)
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(BANDS * BAND_ROWS)], dtype=np.uint64)


def band_keys(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sketch), a row for each run of different shingles that begins at ``starts``: min-hash bands, and one bit of each minimum."""
    keys = np.zeros((len(starts), BANDS), dtype=np.uint64)
    bits = np.zeros((len(starts), SKETCH_WORDS * 64), dtype=np.uint8)
    if len(starts):
        for k, factor in enumerate(_FACTORS):
            low = mix(np.minimum.reduceat(h * factor ^ (h >> np.uint64(k % 31 + 1)), starts))
            bits[:, k] = low & np.uint64(1)
            band = k // BAND_ROWS
            keys[:, band] = mix(keys[:, band] + low + np.uint64(k + 1))
    return keys, np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _sets(chunk: Chunk, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, bounds, class): each text's different shingles, sorted, and one number for its whole sequence of words."""
    h = chunk.hashes()
    run, owner, _ = chunk.shingles(words, h)
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    run, owner = run[new], owner[new]
    count = np.diff(chunk.bounds)
    place = np.arange(len(h)) - np.repeat(chunk.bounds[:-1], count)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(h * (2 * place + 1).astype(np.uint64)), dtype=np.uint64)))
    whole = mix(sums[chunk.bounds[1:]] - sums[chunk.bounds[:-1]] + mix(count.astype(np.uint64)))
    return run, np.searchsorted(owner, np.arange(chunk.size + 1)), whole


def _mark(node: np.ndarray, cls: np.ndarray) -> np.ndarray:
    return mix(cls ^ mix(node.view(np.uint64)))


def _shingle_sets(wanted: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(cls, shingles) of the classes ``needed`` (cls, node, mark), each from the text of its node.

    Texts are read again, so no shingles are kept of those that share no key; a bitmap of 2 MB holds back nearly all others.
    """
    shared = wanted.sparkSession.sparkContext.broadcast(contamination.bitmap(needed.select(F.array("mark").alias("mark")), "mark"))

    def build(batch: pa.RecordBatch) -> dict:
        at, classes, lists = [], [], []
        node = batch.column(0).to_numpy()
        for chunk in chunks(batch.column(1), NOT_SPACE):
            run, bounds, whole = _sets(chunk, words)
            for k in np.flatnonzero(contamination.in_bitmap(shared.value, _mark(node[chunk.first : chunk.first + chunk.size], whole))):
                at.append(int(node[chunk.first + k]))
                classes.append(int(whole[k : k + 1].view(np.int64)[0]))
                lists.append(run[bounds[k] : bounds[k + 1]].view(np.int64))
        return {"node": pa.array(at, pa.int64()), "cls": pa.array(classes, pa.int64()), "shingles": pa.array(lists, pa.list_(pa.int64()))}

    found = map_batches(wanted, "node bigint, cls bigint, shingles array<bigint>", build)
    found = found.join(needed.select("node", "cls"), ["node", "cls"])
    return stage(found.groupBy("cls").agg(F.any_value("shingles").alias("shingles")), "sets")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component): for each document, by the integer ids of ``docs``, the smallest id of its group.

    Documents whose sets of different shingles of ``words`` words have a Jaccard similarity of at least ``similarity`` (0.8 or more) are
    linked, and no others.  Candidates share one of ``BANDS`` min-hash keys, which depends on the similarity alone and not on the length;
    every candidate is checked by the exact similarity of the two sets.  Before that, only pairs go whose sizes rule it out, and those
    whose one-bit minima differ six standard deviations more often than they do at ``similarity``.  Texts that are equal once
    lower-cased and cut into words are one class from the start; texts without a word are one class.  Rows with a null id are left
    out; repeated ids count once.
    """
    if not SIMILARITY <= similarity <= 1:
        raise ValueError("the keys find pairs at 0.8 and more only")
    wanted = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).alias("text"))
    short = [f"s{k}" for k in range(SKETCH_WORDS)]

    def build(batch: pa.RecordBatch) -> dict:
        node = batch.column(0).to_numpy()
        cls, size = (np.zeros(batch.num_rows, dtype=np.uint64) for _ in range(2))
        sketch = np.zeros((batch.num_rows, SKETCH_WORDS), dtype=np.uint64)
        keys = np.zeros((batch.num_rows, BANDS), dtype=np.uint64)
        for chunk in chunks(batch.column(1), NOT_SPACE):
            run, bounds, whole = _sets(chunk, words)
            rows = slice(chunk.first, chunk.first + chunk.size)
            cls[rows], size[rows] = whole, np.diff(bounds)
            some = np.flatnonzero(np.diff(bounds))
            keys[chunk.first + some], sketch[chunk.first + some] = band_keys(run, bounds[some])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
        columns = {n: sketch[:, k].copy().view(np.int64) for k, n in enumerate(short)}
        return {"node": node, "cls": cls.view(np.int64), "mark": _mark(node, cls).view(np.int64), "size": size.view(np.int64), **columns, "keys": lists}

    schema = ", ".join(["node bigint", "cls bigint", "mark bigint", "size bigint", *(f"{c} bigint" for c in short), "keys array<bigint>"])
    signed = stage(map_batches(wanted, schema, build), "signed")
    classes = signed.groupBy("cls").agg(F.min(F.struct("node", "mark", "size", *short, "keys")).alias("one")).select("cls", "one.*")
    classes = stage(classes, "classes")
    compared = ["cls", "size", *short]
    rows, share = BANDS * BAND_ROWS, (1 - similarity) / 2
    limit = int(rows * share + 6 * np.sqrt(rows * share * (1 - share)))

    def near(a: str, b: str) -> Column:
        differing = sum((F.bit_count(F.col(f"{c}_{a}").bitwiseXOR(F.col(f"{c}_{b}"))) for c in short), F.lit(0))
        x, y = F.col(f"size_{a}"), F.col(f"size_{b}")
        return (differing <= limit) & (F.least(x, y) >= F.greatest(x, y) * similarity - 1e-9)

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.where(F.col("size") > 0).select(*(c for c in frame.columns if c != "keys"), F.explode("keys").alias("key"))

    # every class against the smallest one under each of its keys
    own = keyed(classes.select(*compared, "keys"))
    lowest = own.groupBy("key").agg(F.min(F.struct(*compared)).alias("low"), F.count("*").alias("n")).where("n > 1")
    lowest = lowest.select("key", *(F.col(f"low.{c}").alias(f"{c}_a") for c in compared))
    star = _side(own, "b").join(lowest.hint("merge"), "key").where("cls_a <> cls_b").select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), near("a", "b").alias("near"))
    star = stage(star.distinct(), "star")
    touched = star.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = _shingle_sets(wanted, stage(classes.select("cls", "node", "mark").join(touched, "cls"), "touched"), words)

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        both = both.select("a", "b", (F.size("x") + F.size("y")).alias("total"), F.size(F.array_intersect("x", "y")).alias("common"))
        return both.where(F.col("common") >= (F.col("total") - F.col("common")) * similarity - 1e-9).select("a", "b")

    first = stage(components(verify(star.where("near").select("a", "b"))), "groups")

    # then classes of different components; of every such pair one is not in the component that is most frequent under the key
    labelled = classes.join(first.toDF("cls", "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    labelled = stage(labelled.select(*compared, "label", "keys"), "labelled")
    own = keyed(labelled)
    count = own.groupBy("key", "label").agg(F.count("*").alias("n"))
    several = count.groupBy("key").agg(F.count("*").alias("labels"), F.max_by("label", "n").alias("most")).where("labels > 1").select("key", "most")
    mixed = stage(own.join(several.hint("merge"), "key"), "mixed")
    rest = _side(mixed.where("label <> most").drop("most"), "a").join(_side(mixed.drop("most"), "b").hint("merge"), "key").where((F.col("label_a") != F.col("label_b")) & near("a", "b"))
    pairs = verify(rest.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct())
    label = labelled.select("cls", "label")
    across = pairs.join(label.toDF("a", "x"), "a").join(label.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    second = stage(components(across), "groups")
    group = label.join(second.toDF("label", "component"), "label", "left").select("cls", F.coalesce("component", "label").alias("group"))
    group = stage(classes.select("cls", "node").join(group, "cls"), "groups")
    named = group.join(group.groupBy("group").agg(F.min("node").alias("component")), "group").select("cls", "component")
    return signed.select("node", "cls").join(stage(named, "named"), "cls").select("node", "component").distinct()
