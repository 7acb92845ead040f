"""Language identification by error-correcting output codes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import map_batches, with_columns
from tideline.llm.text import CHUNK_BYTES, mix

UNKNOWN = "und"
ORDERS = (1, 2, 3)
FEATURES = 1 << 15
EVIDENCE = 60.0
"""An n-gram more than this many adds no confidence: neighbouring n-grams are not independent."""
SMOOTHING = 0.5
AMBIGUOUS_BELOW = 0.6
EXHAUSTIVE_UP_TO = 7


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every n-gram of the letters; all else is one blank, also at both ends.

    Texts without a letter have none.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer(f" {'  '.join(low)} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(low)), np.array([len(t) + 2 for t in low]))
    letter = _letters()[points]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    points, owner, letter = np.where(letter, points, 32)[keep].astype(np.uint64), owner[keep], letter[keep]
    owners, features = [], []
    for n in ORDERS:
        if len(points) < n:
            continue
        size = len(points) - n + 1
        code = np.full(size, n, dtype=np.uint64)
        inside = np.zeros(size, dtype=bool)
        for k in range(n):
            code = (code << np.uint64(21)) | points[k : size + k]
            inside |= letter[k : size + k]
        whole = inside & (owner[:size] == owner[n - 1 :])
        owners.append(owner[:size][whole])
        features.append((mix(code[whole]) >> np.uint64(49)).astype(np.int64))
    if not owners:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(owners), np.concatenate(features)


LONGEST_PIECE = 1 << 20


def _groups(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers, pieces) of the texts, about a chunk at a time; a very long text comes in several pieces."""
    own: list[int] = []
    some: list[str] = []
    size = 0
    for k, text in enumerate(texts):
        for at in range(0, len(text or ""), LONGEST_PIECE):
            own.append(k)
            some.append(text[at : at + LONGEST_PIECE])
            size += len(some[-1])
            if size >= CHUNK_BYTES // 2:
                yield own, some
                own, some, size = [], [], 0
    if own:
        yield own, some


def codewords(n: int) -> np.ndarray:
    """One row of 1 and -1 per language.

    Few languages get every split in two once; more get random splits, of several draws the
    one with the greatest least distance.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE_UP_TO:
        splits = np.arange(1 << (n - 1), (1 << n) - 1)
        return np.array([[1.0 if s >> (n - 1 - row) & 1 else -1.0 for s in splits] for row in range(n)])
    rng = np.random.default_rng(n)
    bits, best, least = 15 * int(np.ceil(np.log2(n))), None, -1
    for _ in range(100):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        distance = (bits - code @ code.T) / 2 + bits * np.eye(n)
        if distance.min() > least and (np.abs(code.sum(0)) < n).all():
            best, least = code, distance.min()
    return best if best is not None else code


@dataclass(frozen=True)
class LanguageModel:
    """``weights[f, b]`` is what n-gram f says for bit b; ``trust[b]`` how far the bit is to be believed."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, whether the two best codewords are close) of each text."""
        margins, seen = np.zeros((len(texts), self.codes.shape[1])), np.zeros(len(texts))
        for own, some in _groups(texts):
            owner, feature = _grams(some)
            order = np.argsort(owner, kind="stable")
            feature, bounds = feature[order], np.searchsorted(owner[order], np.arange(len(some) + 1))
            for k, text in enumerate(own):
                if bounds[k + 1] > bounds[k]:
                    counts = np.bincount(feature[bounds[k] : bounds[k + 1]], minlength=FEATURES)
                    margins[text] += counts.astype(np.float32) @ self.weights
                    seen[text] += bounds[k + 1] - bounds[k]
        margins /= np.maximum(seen, 1)[:, None]
        known = seen > 0
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), known
        evidence = margins * np.minimum(seen, EVIDENCE)[:, None]
        loss = np.logaddexp(0.0, -evidence[:, None, :] * self.codes[None]) @ self.trust
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        score = np.where(known, share.max(1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score, known & (score < AMBIGUOUS_BELOW)


def fit(counts: dict[str, np.ndarray]) -> LanguageModel:
    """A model from the n-gram counts of each language: one naive Bayes classifier for each bit."""
    names = tuple(sorted(counts))
    codes = codewords(len(names))
    if not names:
        return LanguageModel((), codes, np.zeros((FEATURES, 1), dtype=np.float32), np.ones(1))
    shares = np.array([(counts[n] + SMOOTHING) / (counts[n].sum() + SMOOTHING * FEATURES) for n in names])
    if len(names) == 1:
        return LanguageModel(names, codes, np.zeros((FEATURES, 1), dtype=np.float32), np.ones(1))
    one, other = (codes > 0).astype(float), (codes < 0).astype(float)
    weights = np.log((one.T @ shares) / one.sum(0)[:, None]) - np.log((other.T @ shares) / other.sum(0)[:, None])
    expected = (shares @ weights.T) * codes
    trust = np.clip(expected.min(0), 1e-3, None)
    return LanguageModel(names, codes, weights.T.astype(np.float32), trust / trust.sum() * 2)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts the n-grams of all labelled texts; rows without text or language teach nothing.

    Each batch sends one count per language and feature, so the driver gets at most 32,768 numbers for each language.
    """

    def build(batch: pa.RecordBatch) -> dict | None:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        total: dict[str, np.ndarray] = {}
        for own, some in _groups(texts):
            owner, feature = _grams(some)
            spoken = [langs[k] for k in own]
            names = sorted(set(spoken))
            place = np.array([names.index(x) for x in spoken])
            for k, name in enumerate(names):
                some = np.bincount(feature[place[owner] == k], minlength=FEATURES)
                total[name] = total.get(name, 0) + some
        rows = [(n, np.flatnonzero(c), c) for n, c in total.items()]
        if not rows:
            return None
        return {
            "lang": pa.array([n for n, at, _ in rows for _ in range(len(at))], pa.string()),
            "feature": np.concatenate([at for _, at, _ in rows]),
            "n": np.concatenate([c[at] for _, at, c in rows]).astype(np.int64),
        }

    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    sums = map_batches(rows, "lang string, feature bigint, n bigint", build).groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs, features, ns = sums["lang"].to_pylist(), sums["feature"].to_numpy(), sums["n"].to_numpy()
    counts: dict[str, np.ndarray] = {}
    for name in sorted(set(langs)):
        mask = np.array([x == name for x in langs])
        counts[name] = np.bincount(features[mask], weights=ns[mask], minlength=FEATURES)
    return fit(counts)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_ambiguous; columns of these names are replaced.

    A text that is null or has no letter is ``und`` with score 0.  Repeated rows get the same answer; a
    tie goes to the language that sorts first.  Whole texts are read, one scan, no shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 32,768 floats for each bit
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "lang_score", "lang_ambiguous")]
    kept = docs.select(*(F.col(f"`{c}`") for c in names))

    def build(batch: pa.RecordBatch) -> dict:
        best, score, unsure = shared.value.predict(batch.column(names.index(text_col)).to_pylist())
        own = {n: batch.column(k) for k, n in enumerate(names)}
        return {**own, "lang_pred": pa.array(best, pa.string()), "lang_score": score, "lang_ambiguous": unsure}

    return map_batches(kept, with_columns(kept, "lang_pred string, lang_score double, lang_ambiguous boolean"), build)
