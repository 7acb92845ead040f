"""A bigram language model in a log-frequency Bloom filter, and exact add-one unigrams beside it.

Counts of words and word pairs are gathered over all training texts.  A count c is kept as q = 1 + floor(log2 c), by setting the
bits of the events (n-gram, 1) to (n-gram, q) in a Bloom filter.  Whoever asks for level 1, 2, ... until one is missing learns
c within a factor of two.  As one is taken off the count of every pair, pairs seen once say nothing, and pairs start at level 2.
The filter is blocked: all bits of an n-gram are in one segment, so segments are built where the counts of their n-grams lie, and only bits travel.

The filter grows with the corpus.  Up to ``MAX_BITS`` bits (64 MB) it is broadcast to the workers; a larger one stays a table of
segments, and the n-grams of each piece of text are sent to their segments and come back with their levels.  Probes, levels and scores are
the same both ways, bit by bit.

Scores are log probabilities.  Counts are taken low where they are shared out and high where they divide, less one for a pair, so that
neither quantising nor a level found by chance gives the words after a context more than all of the mass; see ``Model.score``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import importable, map_batches
from tideline.llm.text import Chunk, byte_runs, chunks, mix
from tideline.session import stage

MAX_BITS = 1 << 29
MIN_BITS = 1 << 25
BITS_PER_EVENT = 16
PROBES = (12, 6)
"""Bits of an n-gram's first event, so that hardly any is found that was never seen, and of each further one."""
SEGMENTS_LOG = 10
SEGMENT_BITS_LOG = 19
"""There are 1,024 segments, or as many as keep each of them at 64 KB."""
LEVELS = 48
HEAD_WORDS = 1 << 17
"""Words whose exact counts are broadcast: the most frequent ones, 2 MB.  The others' counts are joined."""
FLUSH = 3 << 20
ROWS_OUT = 1 << 16
HELD_SEGMENTS = 256
BUCKET_LOG = 3
"""Eight neighbouring segments, 512 KB, answer together: their number times that of the pieces of text is that of the rows asked, so it is kept low."""
SCORE_BYTES = 3 << 19
"""Text that is scored at once: the more, the more often an n-gram that is looked up once is there again."""
PIECE_BYTES = 4 << 20
SCORED = ["id", "row", "n_tokens", "n_known", "known", "score", "others"]
START, END = np.uint64(0x5BD1E995A5A5A5A4), np.uint64(0x27D4EB2F165667C4)
PAIR_WEIGHT = 0.3
MARGIN = 4.0
"""Times the mean of what chance adds to the words after a context, so that hardly any context gets more."""
BACK_OFF = 4.0
"""After a word seen n times, its pairs weigh at most ``PAIR_WEIGHT``, and that n against this."""


def _tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, pair hash, bounds): each text's words and one end.  The lowest bit tells words (0) from pairs (1)."""
    ends = chunk.bounds[1:] + np.arange(chunk.size)
    n = len(chunk.starts) + chunk.size
    word = np.empty(n, dtype=np.uint64)
    is_end = np.zeros(n, dtype=bool)
    is_end[ends] = True
    word[~is_end] = chunk.hashes() & ~np.uint64(1)
    word[is_end] = END
    bounds = np.concatenate(([0], ends + 1))
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[bounds[:-1]] = START
    pair = mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(word)) | np.uint64(1)
    return word, pair, bounds


def _segment(column: str = "h") -> Column:
    return F.shiftrightunsigned(column, 64 - SEGMENTS_LOG)


def count_ngrams(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, n): every word and pair with its count; an odd h is a pair.  Written, with all of a segment in one task's file."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.concatenate(held)
            held.clear()
            h.sort()
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            for lo in range(0, len(first), ROWS_OUT):
                at = first[lo : lo + ROWS_OUT + 1]
                n = np.diff(at if len(at) > ROWS_OUT else np.append(at, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(h[at[: len(n)]].view(np.int64)), pa.array(n.astype(np.int32))], names=["h", "n"])

        for batch in batches:
            for chunk in chunks(batch.column(0)):
                word, pair, _ = _tokens(chunk)
                held += [word, pair]
                size += 2 * len(word)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    importable(texts.sparkSession)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = texts.select(F.col(text_col)).mapInArrow(run, "h bigint, n int").repartition(parts, _segment())
    return stage(counted.groupBy(_segment().alias("segment"), "h").agg(F.sum("n").alias("n")).select("h", "n"), "counts")


def _levels(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(float))[1]


def _least(level: np.ndarray) -> np.ndarray:
    """The smallest count of a level."""
    return np.where(level > 0, 2.0 ** (level - 1), 0.0)


def _most(level: np.ndarray) -> np.ndarray:
    """The greatest count of a level."""
    return 2.0**level - 1


def segments_log(size_log: int) -> int:
    return max(SEGMENTS_LOG, size_log - SEGMENT_BITS_LOG)


def _bits(h: np.ndarray, level: int, size_log: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, step, base): probe k of an n-gram at a level is the bit base + (first + k * step + k^3), the latter within its segment."""
    g = mix(h + np.uint64(level * 0xA0761D6478BD642F % (1 << 64)))
    base = (h >> np.uint64(64 - segments_log(size_log))) << np.uint64(size_log - segments_log(size_log))
    return g, (g >> np.uint64(32)) | np.uint64(1), base


def _probe(first: np.ndarray, step: np.ndarray, base: np.ndarray, k: int, size_log: int) -> np.ndarray:
    return base | ((first + np.uint64(k) * step + np.uint64(k**3)) & np.uint64((1 << (size_log - segments_log(size_log))) - 1))


def _kinds(h: np.ndarray, level: int) -> list[tuple[np.ndarray, int]]:
    """(which n-grams, how many probes) at a level: words start at level 1, pairs at level 2."""
    pairs = (h & np.uint64(1)).astype(bool)
    if level == 1:
        return [(~pairs, PROBES[0])]
    return [(~pairs, PROBES[1]), (pairs, PROBES[0])] if level == 2 else [(np.ones(len(h), dtype=bool), PROBES[1])]


def _events(h: np.ndarray, q: np.ndarray, size_log: int) -> np.ndarray:
    """All bits to be set for n-grams of level q."""
    places = [np.zeros(0, dtype=np.uint64)]
    for level in range(1, int(q.max(initial=0)) + 1):
        some = h[q >= level]
        for which, probes in _kinds(some, level):
            bits = _bits(some[which], level, size_log)
            places += [_probe(*bits, k, size_log) for k in range(probes)]
    return np.unique(np.concatenate(places))


@dataclass(frozen=True)
class Filter:
    """Bits of a blocked Bloom filter, or with ``first`` those from that bit on."""

    bits: np.ndarray
    size_log: int
    first: int = 0

    def has(self, h: np.ndarray, level: int, probes: int) -> np.ndarray:
        """The places in ``h`` of the n-grams that have this level."""
        there, (first, step, base) = np.arange(len(h)), _bits(h, level, self.size_log)
        for k in range(probes):
            place = _probe(first, step, base, k, self.size_log) - np.uint64(self.first)
            found = np.flatnonzero(self.bits[(place >> np.uint64(3)).view(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
            if len(found) < len(there):
                there, first, step, base = there[found], first[found], step[found], base[found]
        return there

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram: each different one is looked up once, in the order of the segments, as memory is slow to read at random."""
        kinds, own = np.unique(h, return_inverse=True)
        return self._levels(kinds)[own]

    def _levels(self, h: np.ndarray) -> np.ndarray:
        """They are asked for until one is missing."""
        out = np.zeros(len(h), dtype=np.int8)
        asked = np.arange(len(h))
        pairs = (h & np.uint64(1)).astype(bool)
        for level in range(1, LEVELS + 1):
            found = [np.flatnonzero(pairs)] if level == 1 else []
            some = h[asked]
            for which, probes in _kinds(some, level):
                own = asked[which]
                hit = own[self.has(h[own], level, probes)]
                out[hit] = level
                found.append(hit)
            asked = np.concatenate(found)
            if not len(asked):
                break
        return out


@dataclass(frozen=True)
class Answers:
    """What a filter has said of some n-grams, sorted by hash."""

    h: np.ndarray
    level: np.ndarray

    def levels(self, h: np.ndarray) -> np.ndarray:
        return self.level[np.searchsorted(self.h, h)]


@dataclass(frozen=True)
class Segments:
    """A filter that is too large to broadcast: (segment, bits)."""

    table: DataFrame
    size_log: int


def _either(parts: pa.Table) -> pa.Table:
    """The bits of one segment that several tasks have set."""
    bits = np.bitwise_or.reduce([np.frombuffer(b, dtype=np.uint8) for b in parts["bits"].to_pylist()])
    ones = int(np.unpackbits(bits).sum())
    return pa.table({"segment": parts["segment"][:1], "bits": pa.array([bits.tobytes()], pa.binary()), "ones": pa.array([ones], pa.int64())})


def build_filter(counts: DataFrame) -> tuple[Filter | Segments, float]:
    """The filter over all counts, and the share of its bits that are set; up to ``MAX_BITS`` the bits come to the driver."""
    pair = F.col("h").bitwiseAND(1)
    told = counts.where((pair == 0) | (F.col("n") > 1))
    events = told.agg(F.sum(F.floor(F.log2("n") + F.lit(1e-9)) + 1 - pair)).first()[0] or 0
    wanted = max(MIN_BITS, events * BITS_PER_EVENT)
    size_log = int(wanted - 1).bit_length()
    inner_log = size_log - segments_log(size_log)
    block = 1 << (inner_log - 3)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            h, n = (batch.column(k).to_numpy() for k in (0, 1))
            place = _events(h.view(np.uint64), _levels(n), size_log)
            owner = (place >> np.uint64(inner_log)).astype(np.int64)
            for some in np.split(place, np.flatnonzero(np.diff(owner)) + 1) if len(place) else ():
                bits = segments.setdefault(int(some[0] >> np.uint64(inner_log)), np.zeros(block * 8, dtype=bool))
                bits[(some & np.uint64(block * 8 - 1)).astype(np.int64)] = True
            if len(segments) > HELD_SEGMENTS:
                yield from flush(segments)
        yield from flush(segments)

    def flush(segments: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for s, bits in segments.items():
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["segment", "bits"])
        segments.clear()

    importable(counts.sparkSession)
    parts = told.mapInArrow(run, "segment bigint, bits binary")
    whole = parts.groupBy("segment").applyInArrow(_either, "segment bigint, bits binary, ones bigint")
    if 1 << size_log > MAX_BITS:
        table = stage(whole, "segments")
        return Segments(table, size_log), (table.agg(F.sum("ones")).first()[0] or 0) / (1 << size_log)
    out = np.zeros(1 << (size_log - 3), dtype=np.uint8)
    whole = whole.toArrow()
    for segment, bits in zip(whole["segment"].to_pylist(), whole["bits"].to_pylist(), strict=True):
        out[segment * block : (segment + 1) * block] = np.frombuffer(bits, dtype=np.uint8)
    return Filter(out, size_log), sum(whole["ones"].to_pylist()) / (1 << size_log)


@dataclass(frozen=True)
class Model:
    """``chance`` is what a pair that was never seen may be taken for, on average and with a margin: an upper bound of its count less one."""

    filter: Filter | Answers | None
    tokens: int
    words: int
    chance: float
    head: np.ndarray
    head_counts: np.ndarray

    def seen(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(at least, at most) how often each word was seen: exact for the head, else the bounds of its level."""
        return self.bounds(word)[:2]

    def bounds(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``seen`` tells, and whether each word is of the head, which is not looked up in the filter."""
        kinds, own = np.unique(word, return_inverse=True)
        least, most, exact = np.zeros(len(kinds)), np.zeros(len(kinds)), np.zeros(len(kinds), dtype=bool)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, kinds), len(self.head) - 1)
            exact = self.head[at] == kinds
            least[exact] = most[exact] = self.head_counts[at[exact]]
        level = self.filter.levels(kinds[~exact])
        least[~exact], most[~exact] = _least(level), _most(level)
        return least[own], most[own], exact[own]

    def score(self, least: np.ndarray, most: np.ndarray, pair: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after the one before: weight * pairs / room + (1 - weight) * alone.

        ``least`` and ``most`` are what ``seen`` tells of the words.

        Alone is (c + 1) / (tokens + words + 1) with c rounded down, so over all words and one unknown it sums to 1 at most.  A pair counts
        as the least count of its level less one, which discounts each kind of pair by one at least; room is the context's count rounded up, and
        beside it what chance may add over all words.
        """
        before = np.empty_like(most)
        before[1:] = most[:-1]
        before[bounds[:-1]] = max(self.texts, 1)
        pairs = np.maximum(_least(self.filter.levels(pair)) - 1, 0)
        alone = (least + 1) / (self.tokens + self.words + 1)
        weight = PAIR_WEIGHT * before / (before + BACK_OFF)
        after = np.minimum(pairs / np.maximum(before + self.words * self.chance, 1), 1.0)
        return np.log10(weight * after + (1 - weight) * alone)

    @property
    def texts(self) -> int:
        at = np.searchsorted(self.head, END)
        return int(self.head_counts[at]) if at < len(self.head) and self.head[at] == END else 0


def chance_of(full: float) -> float:
    """The mean count less one of a pair that was never seen, by bits set for others, times ``MARGIN``."""
    return MARGIN * sum((2.0 ** (q - 1) - 1) * full ** (PROBES[0] + (q - 2) * PROBES[1]) for q in range(2, LEVELS))


def train(texts: DataFrame, text_col: str = "text") -> tuple[Model, Segments | None, DataFrame]:
    """(model, segments, counts): the model to broadcast, the filter if that is too large to be in it, and the exact counts (h, n)."""
    counts = count_ngrams(texts, text_col)
    words = counts.where(F.col("h") % 2 == 0)
    total = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    head = words.orderBy(F.desc("n"), "h").limit(HEAD_WORDS).toArrow()
    h, n = head["h"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(h)
    made, full = build_filter(counts)
    split = isinstance(made, Segments)
    model = Model(None if split else made, total["tokens"] or 0, total["words"], chance_of(full), h[order], n[order])
    return model, made if split else None, counts


def _score_chunk(m: Model, ids: pa.Array, row: np.ndarray, chunk: Chunk, tokens: tuple[np.ndarray, ...] | None = None) -> pa.RecordBatch:
    """What is known of each text of a chunk, and the words whose exact counts are still to be joined; ``tokens`` if its ``_tokens`` are at hand."""
    word, pair, bounds = tokens or _tokens(chunk)
    least, most, hit = m.bounds(word)
    logs = np.where(hit, np.log10(least + 1.0), 0.0)
    other = np.concatenate(([0], np.cumsum(~hit)))[bounds]
    columns = [
        ids,
        pa.array(row),
        pa.array(np.diff(bounds)),
        pa.array(np.add.reduceat(hit, bounds[:-1], dtype=np.int64)),
        pa.array(np.add.reduceat(logs, bounds[:-1])),
        pa.array(np.add.reduceat(m.score(least, most, pair, bounds), bounds[:-1])),
        pa.ListArray.from_arrays(pa.array(other, pa.int32()), pa.array(word[~hit].view(np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=SCORED)


def _answer(asked: pa.Table, held: pa.Table, size_log: int) -> pa.Table:
    """(bucket, piece, levels) of the n-grams that pieces ask of one bucket, whose segments are ``held``: all are looked up together."""
    bucket, runs = asked["bucket"], asked["h"].combine_chunks()
    inner_log, told = size_log - segments_log(size_log), []
    if len(bucket):
        block, first = 1 << (inner_log - 3), bucket[0].as_py() << BUCKET_LOG
        bits = np.zeros(block << BUCKET_LOG, dtype=np.uint8)
        for segment, own in zip(held["segment"].to_pylist(), held["bits"].to_pylist(), strict=True):
            bits[(segment - first) * block : (segment - first + 1) * block] = np.frombuffer(own, dtype=np.uint8)
        level = Filter(bits, size_log, first << inner_log).levels(runs.flatten().to_numpy().view(np.uint64)).tobytes()
        ends = np.cumsum(runs.value_lengths().to_numpy()).tolist()
        told = [level[lo:hi] for lo, hi in itertools.pairwise((0, *ends))]
    return pa.table([bucket, asked["piece"], pa.array(told, pa.binary())], names=["bucket", "piece", "levels"])


def _score_by_segments(texts: DataFrame, kind: str, schema: str, shared: Broadcast, segments: Segments) -> DataFrame:
    """The rows that ``score`` makes with a filter at hand, from segments that stay where they are.

    Texts are numbered in pieces of a few megabytes and written.  Each piece asks once for each of its different n-grams: they go
    to the buckets of their segments in sorted runs, and only their levels, a byte each, come back.  A bucket looks each n-gram up once,
    however many pieces ask for it.
    """
    size_log = segments.size_log
    shift = np.uint64(64 - segments_log(size_log) + BUCKET_LOG)

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = piece = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, _, offsets in byte_runs(batch.column(1), PIECE_BYTES):
                n = len(offsets) - 1
                columns = [pa.array(np.full(n, piece)), pa.array(np.arange(row, row + n)), batch.column(0).slice(lo, n), batch.column(1).slice(lo, n)]
                yield pa.RecordBatch.from_arrays(columns, names=["piece", "row", "id", "text"])
                row, piece = row + n, piece + 1

    def asked_by(tokens: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.unique(np.concatenate([np.unique(np.concatenate(t[:2])) for t in tokens]))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = batch.column(0).to_numpy()
            for a, b in itertools.pairwise((*np.flatnonzero(np.diff(piece, prepend=piece[:1] - 1)), len(piece))):
                h = asked_by(_tokens(c) for c in chunks(batch.column(1).slice(a, b - a)))
                owner, first = np.unique(h >> shift, return_index=True)
                runs = pa.ListArray.from_arrays(pa.array(np.append(first, len(h)), pa.int32()), pa.array(h.view(np.int64)))
                same = pa.array(np.full(len(owner), piece[a]))
                yield pa.RecordBatch.from_arrays([pa.array(owner.astype(np.int64)), same, runs], names=["bucket", "piece", "h"])

    def tell(texts: pa.Table, known: pa.Table) -> pa.Table:
        level = np.frombuffer(b"".join(known.sort_by("bucket")["levels"].to_pylist()), dtype=np.int8)
        ids, row = texts["id"].combine_chunks(), texts["row"].to_numpy()
        parts = [(c, _tokens(c)) for c in chunks(texts["text"])]
        m = replace(shared.value, filter=Answers(asked_by(tokens for _, tokens in parts), level))
        made = [_score_chunk(m, ids.slice(c.first, c.size), row[c.first : c.first + c.size], c, tokens) for c, tokens in parts]
        return pa.Table.from_batches(made)

    numbered = stage(texts.mapInArrow(number, f"piece bigint, row bigint, id {kind}, text string"), "numbered")
    asked = numbered.select("piece", "text").mapInArrow(ask, "bucket bigint, piece bigint, h array<bigint>")
    held = segments.table.select(F.shiftright("segment", BUCKET_LOG).alias("bucket"), "segment", "bits")
    known = asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(lambda a, b: _answer(a, b, size_log), "bucket bigint, piece bigint, levels binary")
    return numbered.groupBy("piece").cogroup(known.groupBy("piece")).applyInArrow(tell, schema)


def score(docs: DataFrame, model: Model, segments: Segments | None, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens, base_score, score): one row per row of ``docs``.

    A null or empty text is its end alone.  Texts of any length are read whole, in pieces of a few
    megabytes.  Repeated rows, equal ids and null ids are scored each for itself.  With nothing to learn from every token has probability 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, row bigint, n_tokens bigint, n_known bigint, known double, score double, others array<bigint>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered = TaskContext.get().partitionId() << 36
        for batch in batches:
            for chunk in chunks(batch.column(1), limit=SCORE_BYTES):
                yield _score_chunk(shared.value, batch.column(0).slice(chunk.first, chunk.size), np.arange(numbered, numbered + chunk.size), chunk)
                numbered += chunk.size

    importable(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _score_by_segments(texts, kind, schema, shared, segments) if segments else texts.mapInArrow(run, schema)
    scored = stage(found, "scored")
    rare = counts.where(F.col("h") % 2 == 0)
    if len(model.head) == HEAD_WORDS:
        rare = rare.where(F.col("n") <= int(model.head_counts.min()))
    tail = scored.select("row", F.explode("others").alias("h")).join(rare.hint("merge"), "h")  # Spark takes the lists for one row each
    tail = tail.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_known"))
    denominator = float(np.log10(model.tokens + model.words + 1))
    return scored.drop("others").join(tail, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0.0)) - F.col("n_tokens") * denominator).alias("base_score"),
        "score",
    )
