"""Quality rules: counts over whole texts, and a hashed n-gram classifier.

Counts per text: words, code points in words, symbols, repeated lines, and the
words inside 8-word windows that occur at least twice.  The classifier is
logistic regression over the relative frequencies of hashed words, word pairs
and byte 4-grams; it is trained on labelled quality rows, its output becomes a
probability by Platt scaling on a fold that training did not see, and a text is
kept at ``KEEP_AT`` or more.

The classifier is fitted on a bounded sample: the ``sample_rows`` labelled
rows with the smallest hash of doc_id.  Everything else covers every row and
whole texts, in Arrow batches; the largest thing in memory is a few arrays as
long as a slice of texts or as one longer text.

Defined results: a null text has no words; where the sample has no two classes
the classifier keeps everything; repeated rows each get their row; an empty
table gives no rows.  Only the named columns are read, so extra columns never
clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import map_arrow, slices, text_buffer, text_bytes

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Probability of good quality from which a text is kept.
KEEP_AT = 0.5
#: Labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 3_000
#: Hashed features of each family: words, word pairs, byte 4-grams.
FEATURES, FAMILIES = 1 << 15, 3
#: Every n-th sampled row calibrates and does not train.
CALIBRATION_FOLD = 4
STEPS, RATE, RIDGE = 300, 0.5, 1e-5

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _segment_sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)


@dataclass
class Words:
    """The words of a run of texts: a code for each word, the text it is in
    (ascending), and the distinct words that the codes stand for."""

    codes: np.ndarray
    owner: np.ndarray
    distinct: list[str]
    texts: int

    @staticmethod
    def of(column: pa.Array) -> Words:
        parts = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = parts.flatten().dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(column)), pc.list_value_length(parts).to_numpy())
        if "" in distinct:  # white space at an end of a text
            real = codes != distinct.index("")
            codes, owner = codes[real], owner[real]
        return Words(codes, owner, distinct, len(column))

    def repeated(self) -> np.ndarray:
        """Words of each text inside windows that occur twice or more in it.
        Windows are compared exactly: equal codes, then equal pairs of equal
        halves."""
        n = len(self.codes)
        if n <= WINDOW:
            return np.zeros(self.texts, np.int64)
        rank, span = self.codes, 1
        while span < WINDOW:
            rank = pd.factorize(rank[:-span] * (int(rank.max()) + 1) + rank[span:])[0]
            span *= 2
        first = np.flatnonzero(self.owner[:len(rank)] == self.owner[span - 1:])
        group = pd.factorize(rank[first] * self.texts + self.owner[first])[0]
        twice = first[np.bincount(group)[group] > 1] if len(group) else first
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, twice, 1)
        np.add.at(edges, twice + span, -1)
        covered = np.cumsum(edges[:-1]) > 0
        return np.bincount(self.owner[covered], minlength=self.texts)


def repeated_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    real = [x for x in lines if x.strip()]
    return len(real) - len(set(real))


def base_counts(column: pa.Array, words: Words) -> dict[str, np.ndarray]:
    n = words.texts
    lengths = np.fromiter(map(len, words.distinct), np.int64, len(words.distinct))
    buf, offsets = text_buffer(column)
    part = buf[offsets[0]:offsets[-1]]
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[part])])[offsets - offsets[0]]
    return {"n_words": np.bincount(words.owner, minlength=n),
            "word_chars": _segment_sums(lengths[words.codes], words.owner, n).astype(np.int64),
            "n_symbols": np.diff(symbols), "n_dup_lines": np.fromiter(map(repeated_lines, text_bytes(column)), np.int64, n),
            "n_repeat_words": words.repeated()}


def features(column: pa.Array, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) of every occurrence, family by family."""
    hashed = np.fromiter((zlib.crc32(w.lower().encode()) for w in words.distinct), np.uint64, len(words.distinct))[words.codes]
    yield words.owner, (hashed % FEATURES).astype(np.int64)
    same = words.owner[1:] == words.owner[:-1]
    pairs = (hashed[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashed[1:])[same]
    yield words.owner[1:][same], (FEATURES + (pairs * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49))).astype(np.int64)
    buf, offsets = text_buffer(column)
    b = _LOWER[buf[offsets[0]:offsets[-1]]]
    if len(b) < 4:
        return
    owner = np.repeat(np.arange(len(column)), np.diff(offsets))
    inside = owner[3:] == owner[:-3]
    gram = (b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24))[inside]
    yield owner[3:][inside], (2 * FEATURES + (gram * np.uint32(0x9E3779B1) >> np.uint32(17))).astype(np.int64)


@dataclass
class Model:
    """Weights over the features and the calibrated line over their score."""

    weights: np.ndarray
    slope: float
    intercept: float

    def probability(self, column: pa.Array, words: Words) -> np.ndarray:
        score = np.zeros(words.texts)
        for owner, feature in features(column, words):
            n = np.bincount(owner, minlength=words.texts)
            score += _segment_sums(self.weights[feature], owner, words.texts) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.intercept, -500, 500)))


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, quality, feature array<int>, share array<float>) of the sampled
    labelled documents."""
    picked = (labels.filter("quality is not null and doc_id is not null").select("doc_id", "quality")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = FEATURES * FAMILIES
        for batch in batches:
            for part in slices(batch):
                column = part.column("text")
                words, keys, shares = Words.of(column), [], []
                for owner, feature in features(column, words):
                    n = np.bincount(owner, minlength=words.texts)
                    found, count = np.unique(owner * width + feature, return_counts=True)
                    keys.append(found)
                    shares.append(count / n[found // width])
                key, share = np.concatenate(keys), np.concatenate(shares)
                order = np.argsort(key, kind="stable")
                key, share = key[order], share[order]
                cuts = np.searchsorted(key // width, np.arange(words.texts + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"),
                     pa.ListArray.from_arrays(cuts, pa.array((key % width).astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(share.astype(np.float32)))],
                    names=["doc_id", "quality", "feature", "share"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    return map_arrow(rows, run, "doc_id bigint, quality int, feature array<int>, share array<float>")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    rows = sample(docs, labels, sample_rows).toArrow().sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    good = rows.column("quality").to_numpy() > 0 if len(rows) else np.zeros(0, bool)
    fold = np.arange(len(good)) % CALIBRATION_FOLD == CALIBRATION_FOLD - 1
    if not all(0 < good[f].sum() < f.sum() for f in (fold, ~fold)):
        return None
    feature = rows.column("feature").combine_chunks()
    index = feature.flatten().to_numpy()
    share = rows.column("share").combine_chunks().flatten().to_numpy()
    owner = np.repeat(np.arange(len(good)), feature.value_lengths().to_numpy())
    weights = fit(owner, index, share, good, ~fold)
    score = np.bincount(owner, weights[index] * share, len(good))
    return Model(weights, *platt(score[fold], good[fold]))


def fit(owner: np.ndarray, index: np.ndarray, share: np.ndarray, good: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge by full-batch Adagrad; both classes
    weigh the same."""
    keep = used[owner]
    owner, index, share = owner[keep], index[keep], share[keep]
    importance = np.where(used, np.where(good, 0.5 / (good & used).sum(), 0.5 / (~good & used).sum()), 0)
    weights, squares, bias = np.zeros(FEATURES * FAMILIES), np.full(FEATURES * FAMILIES, 1e-12), 0.0
    for step in range(STEPS):
        p = 1 / (1 + np.exp(-(np.bincount(owner, weights[index] * share, len(good)) + bias)))
        slope = (p - good) * importance
        gradient = np.bincount(index, slope[owner] * share, len(weights)) + RIDGE * weights
        squares += gradient ** 2
        weights -= RATE * gradient / np.sqrt(squares)
        bias -= slope.sum()
    return weights


def platt(score: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic line through (score, label), by
    Newton's method, with Platt's smoothed targets."""
    up, down = good.sum(), (~good).sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    scale = score.std() or 1.0
    x = np.stack([score / scale, np.ones(len(score))])
    line = np.array([0.0, np.log((up + 1) / (down + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(line @ x, -30, 30)))
        gradient = x @ (p - target) + 1e-3 * line
        line -= np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2), gradient)
    return float(line[0] / scale), float(line[1])


def assess(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts, base_failed, kept, probability) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                column = part.column("text")
                words = Words.of(column)
                counts = base_counts(column, words)
                p = shared.value.probability(column, words) if shared.value else np.ones(words.texts)
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, (*counts.values(), failed, ~failed & (p >= KEEP_AT), p))],
                    names=["doc_id", *counts, "base_failed", "kept", "probability"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                     "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                     "n_repeat_words bigint, base_failed boolean, kept boolean, probability double")
