"""Language ID by prediction by partial matching.

For each language a context tree over bytes (ASCII letters lower-cased) of
order 0 to ``MAX_ORDER`` holds counts of the byte that follows.  A byte is
coded in the longest context that the language knows; a byte new to that
context costs an escape (method C: distinct / (total + distinct)) and is coded
one order lower, over the bytes that the longer context does not hold.  The
counts are frozen after training, so the code length of a byte depends only on
the bytes before it and becomes a table; a text's code length in a language is
the exact sum over all its bytes.

The language with the shortest code wins; the score is its posterior under
equal priors, 2^-bits normalised over the languages.

Counts come from a bounded sample: about ``sample_docs`` documents of each
language, picked by a hash of doc_id among the documents outside the held-out
fold (crc32 of doc_id as text, mod 4, is 2).  The tables are bounded by the
bytes of that sample, not by the corpus.  Languages are the distinct non-null
values of ``lang``, a short list by nature.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text where nothing was learned; a null doc_id is in neither fold
(held_out false, never learned from); repeated rows each get their row; an
empty table gives no rows.  Only the named columns are read, so extra columns
never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import map_arrow, slices, text_buffer

#: Longest context in bytes.  Grams below are packed into 4 bytes.
MAX_ORDER = 3
#: Expected documents of each language in the training sample.
SAMPLE_DOCS = 1_000
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Byte values that can occur after folding.
_VALUES = 256 - 26


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """Tables of the frozen trees.  Symbols: 0 before the text, 1 any byte not
    seen in training (and NUL), then the seen bytes.  ``first``, ``pair``, ``triple_row``
    and ``triple`` lead from the last bytes to the longest known context;
    ``bits[context * symbols + symbol]`` has a code length for each language."""

    languages: list[str]
    symbol_of: np.ndarray
    symbols: int
    first: np.ndarray
    pair: np.ndarray
    triple_row: np.ndarray
    triple: np.ndarray
    bits: np.ndarray

    def code_lengths(self, buf: np.ndarray, offsets: np.ndarray, run: int = 1 << 20) -> np.ndarray:
        """Bits of each text in each language.  ``offsets`` delimit the texts
        in ``buf``; ``run`` bytes are worked on at one time."""
        d, a, pad = len(offsets) - 1, self.symbols, MAX_ORDER
        lengths = np.diff(offsets)
        total = np.zeros((d, len(self.languages)))
        symbols = np.zeros(int(lengths.sum()) + pad * d, np.uint8)
        place = np.arange(pad, pad * (d + 1), pad)
        begins = offsets[:-1] - offsets[0]
        n = int(lengths.sum())
        for lo in range(0, n, run):
            hi = min(lo + run, n)
            shift = np.repeat(place, np.clip(begins + lengths, lo, hi) - np.clip(begins, lo, hi))
            symbols[np.arange(lo, hi) + shift] = self.symbol_of[buf[offsets[0] + lo:offsets[0] + hi]]
        for lo in range(0, n, run):
            hi = min(lo + run, n)
            inside = np.clip(begins + lengths, lo, hi) - np.clip(begins, lo, hi)
            at = np.arange(lo, hi) + np.repeat(place, inside)
            s, c, b, z = (symbols[at - k].astype(np.int32) for k in range(4))
            state = self.triple[self.triple_row[z * a + b] * a + c]
            state = np.where(state > 0, state, self.pair[b * a + c])
            state = np.where(state > 0, state, self.first[c])
            some = np.flatnonzero(inside)
            starts = (np.cumsum(inside) - inside)[some]
            total[some] += np.add.reduceat(self.bits[state * a + s], starts, axis=0, dtype=np.float64)
        return total

    def predict(self, column: pa.Array, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(column), np.zeros(len(column))
        bits = self.code_lengths(*text_buffer(column))
        best = bits.argmin(axis=1)
        share = np.exp2(bits.min(axis=1)[:, None] - bits)
        score = np.where(letters, 1 / share.sum(axis=1), 0.0)
        return [self.languages[i] if ok else UNDETERMINED for i, ok in zip(best, letters)], score


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): counts of the packed last bytes and the byte after
    them, for documents (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs, grams, counts = [], [], []
                buf, offsets = text_buffer(part.column("text"))
                owner = np.array(part.column("lang").to_pylist(), dtype=object)
                for lang in set(owner):
                    padded = [np.concatenate([np.zeros(MAX_ORDER, np.uint8), _FOLD[buf[offsets[i]:offsets[i + 1]]]])
                              for i in np.flatnonzero(owner == lang)]
                    keys = []
                    for x in padded:
                        x = x.astype(np.int64)
                        keys.append(x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:])
                    found, n = np.unique(np.concatenate(keys), return_counts=True)
                    langs += [lang] * len(found)
                    grams.append(found)
                    counts.append(n)
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(grams)),
                                                  pa.array(np.concatenate(counts))], names=["lang", "gram", "n"])

    return (map_arrow(docs.select("text", "lang"), run, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from ``text`` and non-null ``lang`` outside the held-out fold."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                         & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    found = dict(sorted(tuple(r) for r in usable.groupBy("lang").count().collect()))
    picked = F.lit(False)
    for lang, n in found.items():
        share = int(min(1.0, sample_docs / n) * (1 << 30))
        picked |= (F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    counts = gram_counts(usable.filter(picked)).toPandas() if found else None
    if counts is None or counts.empty:
        return build([], [], [], [])
    languages = sorted(counts["lang"].unique())
    return build(languages, np.searchsorted(languages, counts["lang"].to_numpy(str)), counts["gram"].to_numpy(),
                 counts["n"].to_numpy())


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Freeze the trees into tables."""
    if not len(languages):
        none = np.zeros(1, np.int32)
        return Model([], np.ones(256, np.uint8), 1, none, none, none, none, np.zeros((1, 0), np.float32))
    languages, lang = list(languages), np.asarray(lang, np.int64)
    gram, n = np.asarray(gram, np.int64), np.asarray(n, np.float64)
    lang, gram, n = (x[gram & 255 > 0] for x in (lang, gram, n))
    parts = np.stack([gram >> 24 & 255, gram >> 16 & 255, gram >> 8 & 255, gram & 255]) if len(gram) else np.zeros((4, 0), np.int64)
    seen = np.unique(parts)
    seen = seen[seen > 0]
    symbol_of = np.ones(256, np.uint8)
    symbol_of[seen] = np.arange(2, len(seen) + 2)
    symbol_of = symbol_of[_FOLD]
    a, langs = len(seen) + 2, len(languages)
    z, b, c, s = symbol_of[parts].astype(np.int64)
    z[parts[0] == 0], b[parts[1] == 0], c[parts[2] == 0] = 0, 0, 0

    def contexts(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contexts, their rows in a table of ``size``, and counts [context, language, symbol]."""
        known, row = np.unique(key, return_inverse=True)
        table = np.zeros((len(known), langs, a))
        np.add.at(table, (row, lang, s), n)
        index = np.zeros(size, np.int32)
        index[known] = np.arange(1, len(known) + 1)
        return known, index, table

    def coded(table: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of the next symbol given counts and those one order lower."""
        total, held = table.sum(axis=2, keepdims=True), table > 0
        distinct = held.sum(axis=2, keepdims=True)
        weight = np.maximum(total + distinct, 1)
        free = np.maximum(1 - (lower * held).sum(axis=2, keepdims=True), 1e-12)
        p = np.where(held, table / weight, distinct / weight * lower / free)
        return np.where(total > 0, p, lower)

    base = np.full((1, langs, a), 1 / _VALUES)
    p0 = coded(contexts(np.zeros(len(gram), np.int64), 1)[2], base) if len(gram) else base
    k1, first, t1 = contexts(c, a)
    p1 = coded(t1, np.broadcast_to(p0, t1.shape))
    k2, pair, t2 = contexts(b * a + c, a * a)
    p2 = coded(t2, p1[first[k2 % a] - 1])
    heads, head = np.unique(z * a + b, return_inverse=True)
    triple_row = np.zeros(a * a, np.int32)
    triple_row[heads] = np.arange(1, len(heads) + 1)
    k3, triple, t3 = contexts((head + 1) * a + c, (len(heads) + 1) * a)
    p3 = coded(t3, p2[pair[heads[k3 // a - 1] % a * a + k3 % a] - 1])
    bits = -np.log2(np.concatenate([p0, p1, p2, p3])).transpose(0, 2, 1).reshape(-1, langs).astype(np.float32)
    pair = np.where(pair > 0, pair + len(k1), 0).astype(np.int32)
    triple = np.where(triple > 0, triple + len(k1) + len(k2), 0).astype(np.int32)
    return Model(languages, symbol_of, a, first, pair, triple_row, triple, bits)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs, score = shared.value.predict(part.column("text"), part.column("letters").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), has_letter(F.col(text_col))),
                     run, "doc_id bigint, lang_pred string, score double")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")


def keep_identified(docs: DataFrame, model: Model, min_score: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is
    determined with at least ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = pa.RecordBatch.from_struct_array(batch.column("row")), 0
            for part in slices(rows):
                letters = batch.column("letters").slice(at, part.num_rows).to_numpy(zero_copy_only=False)
                langs, score = shared.value.predict(part.column("text"), letters)
                keep = np.array([x != UNDETERMINED for x in langs]) & (score >= min_score)
                yield part.filter(pa.array(keep))
                at += part.num_rows

    return map_arrow(docs.select(F.struct("*").alias("row"), has_letter(F.col("text"))), run, docs.schema)
