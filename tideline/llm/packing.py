"""Packing token sequences by minimum bin slack.

Every document is cut into full windows and a remainder shorter than one.  How many remainders there are of each length is a
small table, whatever the corpus.  From it the plan is made: the longest remainder opens a window, a subset-sum
over the other lengths, as bits of one integer, finds the multiset that fills it closest, and walking back
gives how often each length is used.  The same fill is repeated as long as its lengths last.  A gap
that no multiset closes is closed by a piece cut from another remainder, whose rest joins
the table as a new length.  What is left at the end, less than a window, goes into windows of 1024, 512, ... tokens,
so that nothing is padded.  The plan names ranges of ranks within each length, and the documents are
dealt to it by their ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.frames import importable, map_batches
from tideline.session import stage

CAPACITY = 2048
END_ID = 1
FULL_WINDOWS = 1 << 62
"""Sequence ids from here on are full windows of one document; they are unique but not dense."""
RANK_BITS = 44
SLICE = 256
"""Rows with token ids that go out as one Arrow batch."""
BROADCAST_KEYS = 1 << 20
"""Up to so many cut remainders (16 bytes each) are named to the tasks that read the token ids; more are joined by a shuffle."""


@cache
def encoder(vocabulary: str):  # noqa: ANN201
    """The encoder of a vocabulary file of ranks: much faster than, and the same ids as, the library that reads its JSON form."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@dataclass(frozen=True)
class Plan:
    """Entry e places the remainders of one length whose ranks start at ``first[e]`` (with the length in the upper bits).

    ``each[e]`` of them go one behind the other into a sequence, from ``sequence[e]`` and ``offset[e]`` on.  With ``cut[e]`` only
    that many ids of a remainder are placed, and the rest takes a rank from ``rest[e]`` on in its own length.
    """

    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    cut: np.ndarray
    rest: np.ndarray
    sequences: int


def fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths with the greatest sum up to ``room``; of equal ones that with few large lengths."""
    bits, mask = 1, (1 << (room + 1)) - 1
    taken: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True):
        left, some = min(counts[length], room // length), 1
        while left:
            some = min(some, left)
            taken.append((length, some, bits))
            bits |= (bits << (length * some)) & mask
            left, some = left - some, some * 2
        if bits >> room & 1:
            break
    at, used = bits.bit_length() - 1, {}
    for length, some, before in reversed(taken):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + some
            at -= length * some
    return used


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where every remainder goes, given how many there are of each length from 1 to ``capacity`` - 1."""
    left = {n: c for n, c in counts.items() if c > 0}
    given, used_up = dict(left), dict.fromkeys(left, 0)
    total, sequence, entries = sum(n * c for n, c in left.items()), 0, []
    while total:
        window = min(capacity, 1 << (total.bit_length() - 1))
        longest = max(n for n, c in left.items() if c)
        use: dict[int, int] = {}
        if longest <= window:
            left[longest] -= 1
            use = fill(window - longest, left)
            left[longest] += 1
            use[longest] = use.get(longest, 0) + 1
        gap = window - sum(n * k for n, k in use.items())
        source = max((n for n, c in left.items() if c > use.get(n, 0)), default=0) if gap else 0
        times = min(c // (use.get(n, 0) + (n == source)) for n, c in left.items() if use.get(n, 0) + (n == source))
        if window < capacity or total // window < times:
            times = 1
        offset = 0
        for n, k in use.items():
            entries.append((n << RANK_BITS | used_up[n], k, sequence, offset, 0, 0))
            used_up[n] += k * times
            left[n] -= k * times
            offset += n * k
        if gap:
            rest = source - gap
            entries.append((source << RANK_BITS | used_up[source], 1, sequence, offset, gap, given.get(rest, 0)))
            used_up[source] += times
            left[source] -= times
            given[rest] = given.get(rest, 0) + times
            left[rest] = left.get(rest, 0) + times
            used_up.setdefault(rest, 0)
        sequence += times
        total -= window * times
    columns = np.array(sorted(entries), dtype=np.int64).reshape(-1, 6).T
    return Plan(*columns, sequence)


def tokenise(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: its full windows' checksums, and its remainder with a rank within the batch.

    A batch is a few thousand rows of one task, and its number is part of the result, so this is written before it is used.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "part", "place", "doc_tokens", "windows", "before", "length", "rank", "crc", "ids"]
    schema = f"doc_id {kind}, part bigint, place int, doc_tokens bigint, windows array<bigint>, before bigint, length int, rank bigint, crc bigint, ids binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encode = encoder(vocabulary)
        small = "<u2" if encode.n_vocab <= 1 << 16 and end_id < 1 << 16 else "<u4"
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        for number, batch in enumerate(batches):
            part = TaskContext.get().partitionId() << 16 | number
            ranks: dict[int, int] = {}
            before = 0
            for lo in range(0, batch.num_rows, SLICE):
                some = batch.slice(lo, SLICE)
                rows: list[list] = [[] for _ in names[2:]]
                for place, text in enumerate(some.column(1).to_pylist(), lo):
                    ids = np.array([*encode.encode(text or "", allowed_special="all"), end_id], dtype=np.uint32)
                    full = len(ids) // capacity
                    windows = [_crc(ids[k * capacity : (k + 1) * capacity]) for k in range(full)]
                    rest = ids[full * capacity :]
                    rank = ranks[len(rest)] = ranks.get(len(rest), -1) + 1
                    row = (place, len(ids), windows, before, len(rest), rank, _crc(rest), rest.astype(small).tobytes())
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                    before += full
                arrays = [pa.array(x, t) for x, t in zip(rows, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.full(some.num_rows, part, dtype=np.int64)), *arrays], names=names)

    importable(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def deal(length: np.ndarray, rank: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """(row, start within the remainder, length, sequence, offset) of every piece of the remainders given."""
    row, start, out = np.arange(len(length)), np.zeros(len(length), dtype=np.int64), []
    length, rank = length.astype(np.int64), rank.astype(np.int64)
    while len(row):
        e = np.searchsorted(plan.first, length << RANK_BITS | rank, side="right") - 1
        nth = rank - (plan.first[e] & ((1 << RANK_BITS) - 1))
        cut = plan.cut[e]
        size = np.where(cut > 0, cut, length)
        out.append((row, start, size, plan.sequence[e] + nth // plan.each[e], plan.offset[e] + nth % plan.each[e] * length))
        more = cut > 0
        row, start, length, rank = row[more], (start + size)[more], (length - size)[more], (plan.rest[e] + nth)[more]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.zeros(0, dtype=np.int64) for _ in range(5))


PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    A null or empty text is its end id alone.  Rows with equal or null ids are documents of their own; of a text
    repeated, each copy is packed.  A text of any length is cut into windows where it is read.  An empty table gives no pieces.
    """
    vocabulary = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = stage(tokenise(docs, vocabulary, end_id, capacity, id_col, text_col), "tokens")
    per_part = rows.where("length > 0").groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # below capacity rows
    plan = make_plan(counts, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = rows.where("length > 0").drop("ids", "windows", "before").join(base, ["length", "part"])
    ranked = ranked.select("doc_id", "part", "place", "doc_tokens", "length", (F.col("rank") + F.col("base")).alias("rank"), "crc")

    def windows(batch: pa.RecordBatch) -> dict | None:
        crcs = batch.column(2)
        many = np.diff(np.asarray(crcs.offsets))
        if not many.sum():
            return None
        row = np.repeat(np.arange(batch.num_rows), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        tokens, part, before = (batch.column(k).to_numpy(zero_copy_only=False)[row] for k in (1, 3, 4))
        return {
            "doc_id": batch.column(0).take(pa.array(row)),
            "start": nth * capacity,
            "length": np.full(len(row), capacity, dtype=np.int64),
            "ids_crc32": crcs.flatten(),
            "doc_tokens": tokens,
            "sequence_id": FULL_WINDOWS | part << 24 | (before + nth),
            "offset": np.zeros(len(row), dtype=np.int64),
        }

    def remainders(batch: pa.RecordBatch) -> dict:
        part, place, tokens, length, rank, crc = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(1, 7))
        row, start, size, sequence, offset = deal(length, rank, shared.value)
        whole = size == length[row]
        return {
            "doc_id": batch.column(0).take(pa.array(row)),
            "start": (tokens - length)[row] + start,
            "length": size,
            "ids_crc32": pa.array(crc[row], mask=~whole),
            "doc_tokens": tokens[row],
            "sequence_id": sequence,
            "offset": offset,
            "part": part[row],
            "place": place[row].astype(np.int32),
            "within": start,
        }

    full = map_batches(rows.select("doc_id", "doc_tokens", "windows", "part", "before"), f"doc_id {kind}, {PIECE}", windows)
    placed = map_batches(ranked, f"doc_id {kind}, {PIECE}, part bigint, place int, within bigint", remainders)
    placed = stage(placed, "placed")
    names = full.columns

    def checked(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(n) for n in names}
        tokens, length = batch.column("remainder").to_numpy(zero_copy_only=False), batch.column("bytes").to_numpy(zero_copy_only=False)
        within, size = batch.column("within").to_pylist(), batch.column("length").to_pylist()
        crcs = []
        for ids, n, a, k in zip(tokens, length, within, size, strict=True):
            crcs.append(_crc(np.frombuffer(ids, dtype=f"<u{len(ids) // n}")[a : a + k]))
        return {**out, "ids_crc32": pa.array(crcs, pa.int64())}

    cut = placed.where("ids_crc32 IS NULL")
    keys = stage(cut.select("part", "place").distinct(), "cut")
    tokens = rows.select("part", "place", F.col("ids").alias("remainder"), F.col("length").alias("bytes"))
    if keys.count() <= BROADCAST_KEYS:
        tokens = tokens.join(F.broadcast(keys), ["part", "place"], "left_semi")
    cut = cut.join(tokens, ["part", "place"])
    cut = map_batches(cut.select(*names, "within", "remainder", "bytes"), f"doc_id {kind}, {PIECE}", checked)
    pieces = full.unionByName(placed.where("ids_crc32 IS NOT NULL").select(*names)).unionByName(cut)
    return pieces.withColumnRenamed("doc_id", id_col)
