"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its evidence is what its bytes and words look like and what those of the
lines beside it look like; a transition matrix ties neighbours together.  The marginals of the
forward-backward pass, weighted by line length, give the share of a document that is bad, and a
logistic curve turns that share into the probability of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.frames import map_batches, remainder, with_columns
from tideline.llm.text import BYTES, Chunk, chunks

SAMPLE_PER_CLASS = 2000
"""Documents of each label that the field is fitted on, those with the smallest hashes."""
SAMPLE_LINES = 200_000
"""Lines of the sampled documents of one label together; documents are taken whole, and those with more than a twentieth of it are not sampled."""
ROUNDS, STEPS, RATE, PENALTY = 2, 80, 0.08, 1e-3

_UPPER = (BYTES >= 65) & (BYTES <= 90)
_LETTER = _UPPER | ((BYTES >= 97) & (BYTES <= 122)) | (BYTES >= 128)
_DIGIT = (BYTES >= 48) & (BYTES <= 57)
_PUNCTUATION = np.isin(BYTES, list(b".,;:'\"()-?"))
_BLANK = (BYTES == 32) | ((BYTES >= 9) & (BYTES <= 13))
_SYMBOL = ~(_LETTER | _DIGIT | _PUNCTUATION | _BLANK)
OWN = 15
WIDTH = 3 * OWN + 1
"""Features of the line, of the one before and of the one after, and a constant."""


@dataclass
class Lines:
    """Lines of some texts: features, length in bytes, and the first line of each text."""

    features: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray


def _repeated(text: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash occurred before in its text."""
    key = np.lexsort((h, text))
    again = np.zeros(len(h), dtype=bool)
    again[key[1:]] = (h[key[1:]] == h[key[:-1]]) & (text[key[1:]] == text[key[:-1]])
    return again


def lines_of(chunk: Chunk) -> Lines:
    """A text without line ends is one line; so is an empty one."""
    raw, offsets = chunk.raw, chunk.offsets
    breaks = np.flatnonzero(raw == 10) + 1
    starts = np.concatenate((offsets[:-1], breaks))
    owner = np.concatenate((np.arange(chunk.size), np.searchsorted(offsets, breaks - 1, side="right") - 1))
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(chunk.size + 1))
    ends = offsets[owner + 1].copy()
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    ends[inner] = starts[inner + 1] - 1
    size = np.maximum(ends - starts, 0)

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[starts + size] - sums[starts]

    letters = np.maximum(count(_LETTER[raw]), 1)
    capital = _UPPER[raw]
    h = chunk.hashes()
    first, last = np.searchsorted(chunk.starts, starts), np.searchsorted(chunk.starts, starts + size)
    words = last - first

    def of_words(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (sums[last] - sums[first]) / np.maximum(words, 1)

    owners = chunk.owners()
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (owners[1:] == owners[:-1])
    run, run_owner, run_first = chunk.shingles(3, h)
    copied = np.zeros(len(h), dtype=bool)
    copied[run_first] = _repeated(run_owner, run)
    closing = raw[chunk.ends - 1] if len(h) else np.zeros(0, dtype=np.uint8)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(h, dtype=np.uint64)))
    whole = sums[last] - sums[first] + words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    n = np.maximum(size, 1)
    own = np.stack(
        [
            count(capital) / letters,
            count(_DIGIT[raw]) / n,
            np.minimum(count(_SYMBOL[raw]) / n, 0.5),
            np.minimum(count(_PUNCTUATION[raw]) / n, 0.3),
            np.minimum(letters / np.maximum(words, 1), 20) / 10,
            of_words(same),
            of_words(copied),
            of_words(_SYMBOL[closing]),
            of_words(closing == 46),
            of_words(chunk.ends - chunk.starts == 1),
            np.log1p(words) / 5,
            (words == 0).astype(float),
            (_repeated(owner, whole) & (words > 0)).astype(float),
            (count(raw == 33) / n > 0.02).astype(float),
            (count(raw == 124) / n > 0.02).astype(float),
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[inner + 1], after[inner] = own[inner], own[inner + 1]
    return Lines(np.concatenate((own, before, after, np.ones((len(own), 1))), axis=1), size + 1.0, bounds)


def marginals(evidence: np.ndarray, bounds: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of every line, and the summed probabilities of neighbouring states (good, bad).

    ``evidence`` is the log weight of bad against good.  All texts take each step together, the long ones alone at last.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    states = np.stack((np.zeros_like(evidence), evidence), axis=1)
    ahead, behind = states.copy(), np.zeros_like(states)
    for t in range(1, steps):
        at = starts[: active[t]] + t
        ahead[at] += np.logaddexp(ahead[at - 1, :1] + ties[0], ahead[at - 1, 1:] + ties[1])
    for t in range(steps - 1, 0, -1):
        at = starts[: active[t]] + t
        back = states[at] + behind[at]
        behind[at - 1] = np.logaddexp(back[:, :1] + ties[:, 0], back[:, 1:] + ties[:, 1])
    total = ahead + behind
    bad = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    later = np.ones(len(evidence), dtype=bool)
    later[bounds[:-1]] = False
    at = np.flatnonzero(later)
    pair = ahead[at - 1][:, :, None] + ties[None] + (states[at] + behind[at])[:, None, :]
    pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
    return bad, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(0)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    ties: np.ndarray
    slope: float
    level: float

    def bad_lines(self, lines: Lines) -> np.ndarray:
        return marginals(((lines.features - self.mean) / self.scale) @ self.weights, lines.bounds, self.ties)[0]

    def bad_share(self, lines: Lines) -> np.ndarray:
        bad = self.bad_lines(lines)
        return np.add.reduceat(bad * lines.weights, lines.bounds[:-1]) / np.add.reduceat(lines.weights, lines.bounds[:-1])

    def score(self, lines: Lines) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.level - self.slope * self.bad_share(lines))))


def _fit_field(x: np.ndarray, bounds: np.ndarray, bad: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent (Adam) on the log-likelihood of the given line labels."""
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    later = np.ones(len(bad), dtype=bool)
    later[bounds[:-1]] = False
    at = np.flatnonzero(later)
    seen = np.zeros((2, 2))
    np.add.at(seen, (bad[at - 1].astype(int), bad[at].astype(int)), 1.0)
    for step in range(1, STEPS + 1):
        p, pairs = marginals(x @ theta[:-4], bounds, theta[-4:].reshape(2, 2))
        slope = np.concatenate(((x * ((bad - p) * weight)[:, None]).sum(0) / len(bad), ((seen - pairs) / len(bad)).ravel())) - PENALTY * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def fit(lines: Lines, label: np.ndarray, prior: float) -> QualityModel:
    """A model from sampled texts with their labels (1 good); ``prior`` is the share of label 1 among all labelled texts.

    At first every line has its text's label.  Then the lines of bad texts that look good to the field are taken as good, all but
    the worst of each text, and the field is fitted again: a bad text may hold good lines.
    """
    mean, scale = lines.features.mean(0), lines.features.std(0)
    mean[-1], scale[-1] = 0.0, 1.0
    scale[scale < 1e-6] = 1.0
    x = (lines.features - mean) / scale
    owner = np.repeat(np.arange(len(label)), np.diff(lines.bounds))
    text_bad = 1.0 - label[owner]
    bad = text_bad.copy()
    for turn in range(ROUNDS):
        weights, ties = _fit_field(x, lines.bounds, bad, np.ones(len(bad)))
        if turn + 1 < ROUNDS:
            evidence = x @ weights
            worst = np.maximum.reduceat(evidence, lines.bounds[:-1])[owner]
            bad = text_bad * ((evidence > 0) | (evidence == worst))
    model = QualityModel(mean, scale, weights, ties, 1.0, 0.0)
    share = model.bad_share(lines)
    balance = np.where(label == 1, prior / max(label.mean(), 1e-9), (1 - prior) / max(1 - label.mean(), 1e-9))
    a, b = 0.0, 4.0
    for _ in range(50):  # Newton on a curve of two numbers, with a small penalty as classes may be separable
        p = 1 / (1 + np.exp(-(a - b * share)))
        r, s = balance * (label - p), balance * p * (1 - p)
        gradient = np.array([r.sum() - 1e-2 * a, -(r * share).sum() - 1e-2 * b])
        hessian = np.array([[s.sum() + 1e-2, -(s * share).sum()], [-(s * share).sum(), (s * share**2).sum() + 1e-2]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + step[0], b + step[1]
    return QualityModel(mean, scale, weights, ties, float(max(b, 0.0)), float(a))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """A model from the labelled documents; labels other than 0 and 1 teach nothing.

    The share of label 1 is that of all labelled rows; the field is fitted on ``SAMPLE_PER_CLASS`` documents of each label at most, with
    ``SAMPLE_LINES`` lines together.  The sample is cut from the labels before any text is read, so the ids that are broadcast are at
    most twice that; of documents with equal ids and texts one counts.  With no row of one of the labels every text gets the share of
    label 1 (one half if there are no labels).
    """
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good")).distinct()
    count = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count("*").alias("n")).collect()}
    total = sum(count.values())
    prior = count.get(1, 0) / total if total else 0.5
    part = [marked.where(F.col("good") == g).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CLASS) for g in (0, 1)]
    sample = F.broadcast(part[0].unionByName(part[1]))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = texts.join(sample, "id").select("good", "id", "text", F.xxhash64("text").alias("mark"))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    sizes = named.select("good", "id", "mark", n_lines.cast("bigint").alias("n_lines")).distinct().where(F.col("n_lines") <= SAMPLE_LINES // 20)
    order = F.struct(F.xxhash64("id"), "id", "mark")
    first = [sizes.where(F.col("good") == g).orderBy(order).limit(SAMPLE_PER_CLASS) for g in (0, 1)]  # so the window has few rows
    before = F.sum("n_lines").over(Window.partitionBy("good").orderBy(order))
    taken = first[0].unionByName(first[1]).withColumn("before", before).where(F.col("before") <= SAMPLE_LINES)

    def build(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"features": [], "weights": []}
        for chunk in chunks(batch.column(3)):
            lines = lines_of(chunk)
            for a, b in zip(lines.bounds[:-1], lines.bounds[1:], strict=True):
                out["features"].append(lines.features[a:b].astype(np.float32).tobytes())
                out["weights"].append(lines.weights[a:b].astype(np.float32).tobytes())
        return {"good": batch.column(0), "id": batch.column(1), "mark": batch.column(2), **{k: pa.array(v, pa.binary()) for k, v in out.items()}}

    chosen = named.join(F.broadcast(taken.select("good", "id", "mark")), ["good", "id", "mark"], "left_semi").select("good", "id", "mark", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    found = map_batches(chosen, f"good int, id {kind}, mark bigint, features binary, weights binary", build)
    rows = found.dropDuplicates(["good", "id", "mark"]).select("good", "features", "weights").toArrow()
    label = np.array(rows["good"].to_pylist(), dtype=float)
    if len(set(label.tolist())) < 2:
        level = float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))
        return QualityModel(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)), 0.0, level)
    order = sorted(range(len(label)), key=lambda k: (label[k], rows["features"][k].as_py()))
    features = [np.frombuffer(rows["features"][k].as_py(), dtype=np.float32).reshape(-1, WIDTH) for k in order]
    weights = np.concatenate([np.frombuffer(rows["weights"][k].as_py(), dtype=np.float32) for k in order])
    bounds = np.concatenate(([0], np.cumsum([len(f) for f in features])))
    return fit(Lines(np.concatenate(features).astype(float), weights.astype(float), bounds), label[order], prior)


def assess(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with quality_score; a column of that name is replaced.

    One scan over whole texts, no shuffle.  A null text counts as empty; an empty text is one empty line and gets a score like any
    other.  Repeated rows get the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred numbers
    names = [c for c in docs.columns if c.lower() != "quality_score"]
    kept = docs.select(*(F.col(f"`{c}`") for c in names))

    def build(batch: pa.RecordBatch) -> dict:
        score = np.zeros(batch.num_rows)
        for chunk in chunks(batch.column(names.index(text_col))):
            score[chunk.first : chunk.first + chunk.size] = shared.value.score(lines_of(chunk))
        return {**{n: batch.column(k) for k, n in enumerate(names)}, "quality_score": score}

    return map_batches(kept, with_columns(kept, "quality_score double"), build)


def held_out(key: str = "doc_id"):  # noqa: ANN201
    """Labels of these documents are not learned from."""
    return remainder(key, 5) == 0
