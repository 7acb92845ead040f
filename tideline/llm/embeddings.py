"""Near-duplicate vectors of equal labels, by a forest of random-projection trees with spill.

Equal vectors of a label are one class.  In each tree the classes of a label are split at the median of a random
projection, again and again, until a cell holds at most ``LEAF``.  Those within ``spill`` of the median go to both sides, so a
close pair is only parted where it lies across the whole band.  Within the leaves all pairs are compared; a pair that meets in
several leaves counts in the first of them.  A cell that no direction divides (its vectors all lie within the band) is a dense
group: it is compared block by block, so that a task never holds more than two blocks.

Splitting needs no vectors, only their projections, and the direction of a level is the same for all cells of a tree.  So the
projections of ``LEVELS_AT_ONCE`` levels are made in one pass; the levels then move some numbers a row, by built-in expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tideline.llm.frames import importable, map_batches
from tideline.llm.groups import components
from tideline.session import stage

COSINE = 0.98
TREES = 4
LEAF = 256
SPILL = 1.0
"""The band to either side of a median, in half standard deviations of a linked pair's difference along a random direction."""
STALLS = 3
LEVELS_AT_ONCE = 16
SEED = 20
DIRECT = 1 << 16
"""Medians up to this many cells go to the workers by broadcast, more by a join."""


def _direction(tree: int, level: int, size: int) -> np.ndarray:
    out = np.random.default_rng((SEED, tree, level, size)).standard_normal(size)
    return out / np.linalg.norm(out)


@cache
def _directions(tree: int, level: int, levels: int, size: int) -> np.ndarray:
    """Those of some consecutive levels, as columns."""
    return np.stack([_direction(tree, k, size) for k in range(level, level + levels)], axis=1)


def _matrix(vectors: Iterable[bytes], kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype=kind) for v in vectors]).astype(np.float64)


def _kind(vectors: DataFrame, column: str) -> str:
    """The numbers that hold each value exactly: floats stay floats until they are compared."""
    of = vectors.schema[column].dataType
    return "float32" if isinstance(of, ArrayType) and isinstance(of.elementType, FloatType) else "float64"


def _classes(valid: DataFrame) -> DataFrame:
    """(node, least, copies, label, raw, vec): one row per different vector of a label; vec holds numbers of its ``_kind``."""
    grouped = valid.groupBy("label", "raw").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    number_kind = _kind(valid, "raw")
    kinds = {c: grouped.schema[c].dataType.simpleString() for c in ("least", "label", "raw")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            vec = [np.asarray(v.values, dtype=number_kind).tobytes() for v in batch.column(3)]
            arrays = [pa.array(np.arange(number, number + batch.num_rows)), *(batch.column(k) for k in range(4)), pa.array(vec, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "least", "copies", "label", "raw", "vec"])
            number += batch.num_rows

    importable(valid.sparkSession)
    schema = f"node bigint, least {kinds['least']}, copies bigint, label {kinds['label']}, raw {kinds['raw']}, vec binary"
    return stage(grouped.select("least", "copies", "label", "raw").mapInArrow(run, schema), "classes")


def _projected(rows: DataFrame, level: int, kind: str) -> DataFrame:
    """``rows`` with the projections of ``LEVELS_AT_ONCE`` levels from ``level`` on, in place of their vectors."""
    levels = LEVELS_AT_ONCE

    def build(batch: pa.RecordBatch) -> dict:
        tree, vectors = batch.column(0).to_numpy(), batch.column(5).to_pylist()
        sizes = np.array([len(v) for v in vectors])
        out = np.zeros((batch.num_rows, levels))
        for t, n in sorted(set(zip(tree.tolist(), sizes.tolist(), strict=True))):
            some = np.flatnonzero((tree == t) & (sizes == n))
            x = _matrix([vectors[k] for k in some], kind)
            out[some] = x / np.linalg.norm(x, axis=1, keepdims=True) @ _directions(t, level, levels, x.shape[1])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), levels).cast(pa.list_(pa.float64()))
        return {n: batch.column(k) for k, n in enumerate(("tree", "cell", "node", "stalls", "band"))} | {"p": lists}

    return map_batches(rows.select("tree", "cell", "node", "stalls", "band", "vec"), "tree int, cell bigint, node bigint, stalls int, band double, p array<double>", build)


def leaves(classes: DataFrame, cosine: float, trees: int) -> DataFrame:
    """(cell, node): every class once for each leaf it falls in."""
    kind, vectors = _kind(classes, "raw"), classes.select("node", "vec")
    roots = classes.withColumn("tree", F.explode(F.array(*(F.lit(t) for t in range(trees)))))
    band = F.lit(float(SPILL * np.sqrt((1 - cosine) / 2))) / F.sqrt(F.size("raw"))
    active = roots.select("tree", F.xxhash64("label", F.size("raw"), "tree").alias("cell"), "node", F.lit(0).alias("stalls"), band.alias("band"), "vec")
    done, level = [], 0

    while True:
        if level % LEVELS_AT_ONCE == 0:
            active = stage(_projected(active.join(vectors, "node") if level else active, level, kind), "projected")
        rows = active.withColumn("x", F.col("p")[0])
        stats = rows.groupBy("cell").agg(F.percentile_approx("x", [0.25, 0.5, 0.75], 500).alias("q"), F.count("*").alias("n"), F.max("stalls").alias("stalled"), F.max("band").alias("widest"))
        dense = F.col("q")[2] - F.col("q")[0] <= 2 * F.col("widest")
        open_cells = (F.col("n") > LEAF) & (F.col("stalled") < STALLS)
        stats = stage(stats.select("cell", F.col("q")[1].alias("middle"), dense.alias("dense"), open_cells.alias("open")), "cells")
        n_open, n_all = stats.agg(F.count_if("open"), F.count("*")).first()
        marked = rows.join(F.broadcast(stats) if n_all <= DIRECT else stats, "cell")
        done.append(marked.where("NOT open").select("cell", "node"))
        if not n_open:
            break
        left = F.when(F.col("dense") | (F.col("x") < F.col("middle") + F.col("band")), F.when(F.col("dense"), 1).otherwise(0))
        right = F.when(~F.col("dense") & (F.col("x") >= F.col("middle") - F.col("band")), 2)
        halves = marked.where("open").withColumn("side", F.explode(F.array_compact(F.array(left, right))))
        cell = F.when(F.col("side") == 1, F.col("cell")).otherwise(F.xxhash64("cell", "side", F.lit(level)))
        stalls = F.col("stalls") + F.col("dense").cast("int")
        rest = F.slice("p", 2, LEVELS_AT_ONCE)
        active = stage(halves.select("tree", cell.alias("cell"), "node", stalls.alias("stalls"), "band", rest.alias("p")), "halves")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return stage(out, "leaves")


def _first_meeting(cells: np.ndarray, a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether ``here`` is the smallest cell that both of each pair are in: no smaller one is in the rows of both."""
    before = cells < here
    kinds, column, count = np.unique(cells[before], return_inverse=True, return_counts=True)
    row, several = np.nonzero(before)[0], count[column] > 1
    row, column = row[several], column[several]
    met = np.zeros((len(cells), len(cells)), dtype=bool)
    for lo in range(0, len(kinds), 1 << 12):
        some = (column >= lo) & (column < lo + (1 << 12))
        held, own = np.unique(column[some], return_inverse=True)
        has = np.zeros((len(cells), len(held)), dtype=np.float32)
        has[row[some], own] = 1
        met |= has @ has.T > 0
    return ~met[a, b]


def compare(group: pd.DataFrame, cosine: float, kind: str = "float64") -> pd.DataFrame:
    """(node, links, root) of the classes of one leaf, or of two blocks of a large one, that have a link there."""
    group = group.sort_values("node", kind="stable")
    x = _matrix(group["vec"], kind)
    norm = np.linalg.norm(x, axis=1)
    near = (x @ x.T) / (norm[:, None] * norm[None, :]) >= cosine
    np.fill_diagonal(near, False)
    block = group["block"].to_numpy()
    if (block != block[0]).any():
        near &= block[:, None] != block[None, :]
    elif group["i"].iloc[0] != group["j"].iloc[0]:
        near[:] = False  # two blocks, one of them empty
    root = np.arange(len(x))
    while True:
        low = np.where(near, root[None, :], len(x)).min(1)
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    a, b = np.nonzero(near)
    width = max(map(len, group["cells"]))
    cells = np.full((len(x), width), np.iinfo(np.int64).max)
    for k, own in enumerate(group["cells"]):
        cells[k, : len(own)] = own
    first = _first_meeting(cells, a, b, int(group["cell"].iloc[0]))
    links = np.bincount(a[first], weights=group["copies"].to_numpy()[b[first]], minlength=len(x)).astype(np.int64)
    node = group["node"].to_numpy()
    linked = near.any(1)
    return pd.DataFrame({"node": node[linked], "links": links[linked], "root": node[root[linked]]})


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    trees: int = TREES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row per row of ``vectors``.

    Vectors link when their labels are equal and not null, their lengths are equal, and their cosine in double
    precision is at least ``cosine``.  Vectors that are null, empty, zero, or hold nulls or numbers that are not finite, link with
    nothing: 0 links, and their own id as component_id.  Equal vectors of a label link with each other, whatever their ids; ids
    that repeat are rows of their own.  component_id is the smallest id that is not null.  Other columns are not read.
    """
    importable(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("raw"), F.col(label_col).alias("label"))
    squares = F.aggregate("raw", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    finite = F.forall("raw", lambda v: v.isNotNull() & ~F.isnan(v))
    valid = F.coalesce(F.col("label").isNotNull() & finite & (squares > 0) & (squares < float("inf")), F.lit(False))
    rows = rows.withColumn("valid", valid)
    classes = _classes(rows.where("valid").select("id", "raw", "label"))
    leaf = leaves(classes, cosine, trees)
    where = leaf.groupBy("node").agg(F.sort_array(F.collect_set("cell")).alias("cells"))  # a few for each tree
    size = leaf.groupBy("cell").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / LEAF).cast("int")
    cut = leaf.join(size, "cell").withColumn("blocks", blocks).withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    # vectors come last, so that they are moved once, to their leaves; Spark takes an array for one number and would broadcast it
    cut = cut.select("cell", "i", "j", "block", "node").join(where.hint("merge"), "node").join(classes.select("node", "copies", "vec").hint("merge"), "node")
    kind = _kind(rows, "raw")
    links = cut.groupBy("cell", "i", "j").applyInPandas(lambda group: compare(group, cosine, kind), "node bigint, links bigint, root bigint")
    links = stage(links, "links")
    group = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(group, "node", "left").join(counted, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = stage(known.select("component", "label", "raw", "least", "copies", F.coalesce("links", F.lit(0)).alias("links")), "known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("label", "raw", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    joined = rows.where("valid").join(known.hint("merge"), ["label", "raw"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT valid").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    both = joined.unionByName(alone)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
