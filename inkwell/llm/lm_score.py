"""Masked pseudo-likelihood of documents.

A small network sees the two words on either side of a word and predicts it:
position-wise embeddings are summed to a hidden layer, which gives the word's
class and then the word within its class (an exact factorisation over the
vocabulary).  A document's score is the sum over its words of
log P(word | both sides).

The network's ids are the most frequent words of all documents, and a fixed
number of buckets for the others.  A bucket's word has the bucket's probability
times n(word) / n(bucket), by the counts of all documents, so every distinct
word has a probability of its own.  Words with over one in ``COMMON`` of all
words are few and looked up by each task; the others of each text are joined
to the counts.

Training goes over every document once, in ``ROUNDS`` folds by a hash of
doc_id: each task starts from the round's parameters and trains in numpy on
every word of its documents, one of ``MASK_EVERY`` offsets after the other, and
the next round starts from the mean of the tasks' parameters, weighted by
words and summed by a shuffle.  Counts and training cover all documents, so
what is gathered grows with them; a task holds one copy of the parameters,
whose size is fixed.

Defined results: a null text or one without words has no words and log
probability 0; null doc_ids train in the first round; a word that the counts
lack counts as seen once; repeated rows each get
their row; an empty table gives no rows.  Only the named columns are read, so
extra columns never clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import map_arrow, slices, text_buffer, written
from inkwell.llm.quality import Words

#: Ids: 0 beyond the ends of a text, then the frequent words, then the hashed.
IDS, HASHED = 1024, 256
FREQUENT = IDS - HASHED - 1
#: An id is class * SIDE + place in the class.
SIDE = 32
#: Offsets of the context words.
CONTEXT = (-2, -1, 1, 2)
HIDDEN, ROUNDS, BATCH, RATE, SEED = 24, 3, 2048, 0.1, 10
#: Every n-th word is masked in training, at each offset in turn.
MASK_EVERY = 7
#: Words with over one in so many of all words are not joined; there are fewer
#: of them than this, so a task can hold them.
COMMON = 200_000
#: Words that are scored at one time: their work arrays stay in a core's cache.
RUN = 1 << 12
#: Parameters of a row in which tasks send theirs.
CHUNK = 1024

TEXT_SLICE = 8 << 20

SHAPES = {"embedding": (len(CONTEXT), IDS, HIDDEN), "hidden": (HIDDEN,), "classes": (HIDDEN, SIDE), "class_bias": (SIDE,),
          "places": (HIDDEN, SIDE), "place_bias": (SIDE, SIDE)}


_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False


def split(column: pa.Array) -> Words:
    """``Words.of`` by one pass over the bytes, the distinct words lower-cased
    (two may then be equal)."""
    buf, offsets = text_buffer(column)
    at, data = offsets - offsets[0], buf[offsets[0]:offsets[-1]]
    inside = _IN_WORD[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    starts = at[:-1][at[:-1] < len(data)]
    begin[starts] = inside[starts]
    first = np.flatnonzero(begin)
    places = np.append(np.cumsum(inside, dtype=np.int32)[first] - 1, np.count_nonzero(inside)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(places), pa.py_buffer(data[inside])).dictionary_encode()
    owner = np.searchsorted(at, first, side="right") - 1
    low = [w.lower() for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
    return Words(words.indices.to_numpy().astype(np.int64), owner, low, len(column))


@dataclass
class Network:
    """Parameters by name, the ids of the frequent words, the counts of the
    buckets, and log(n(word) / n(bucket)) of common words in buckets."""

    vocabulary: dict[str, int]
    parameters: dict[str, np.ndarray]
    hashed: list[int]
    common: dict[str, float]

    @staticmethod
    def start(words: list[str], frequent: list[int], hashed: list[int]) -> Network:
        """Small random weights; the biases are the unigram distribution."""
        rng = np.random.default_rng(SEED)
        counts = np.full(IDS, 0.5)
        counts[0] = 1e-6
        counts[1:1 + len(frequent)] += frequent
        counts[IDS - HASHED:] += hashed
        table = counts.reshape(SIDE, SIDE)
        classes = table.sum(axis=1)
        p = {name: rng.normal(0, 0.1, shape) for name, shape in SHAPES.items()}
        p |= {"hidden": np.zeros(HIDDEN), "class_bias": np.log(classes / classes.sum()), "place_bias": np.log(table / classes[:, None])}
        return Network({w: i + 1 for i, w in enumerate(words)}, {k: v.astype(np.float32) for k, v in p.items()}, hashed, {})

    def ids(self, words: Words) -> np.ndarray:
        known, low = self.vocabulary, words.distinct
        return np.fromiter((known.get(w) or IDS - HASHED + zlib.crc32(w.encode()) % HASHED for w in low),
                           np.int32, len(low))[words.codes]

    def hidden(self, context: list[np.ndarray]) -> np.ndarray:
        p = self.parameters
        total = p["embedding"][0].take(context[0], axis=0)
        for k in range(1, len(context)):
            total += p["embedding"][k].take(context[k], axis=0)
        return np.tanh(total + p["hidden"], out=total)

    def scores(self, hidden: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the classes, and of the places in the target's class."""
        p = self.parameters
        return hidden @ p["classes"] + p["class_bias"], hidden @ p["places"] + p["place_bias"].take(target // SIDE, axis=0)

    def forward(self, context: list[np.ndarray], target: np.ndarray) -> np.ndarray:
        """Log probability of each target."""
        rows = np.arange(len(target))
        one, two = self.scores(self.hidden(context), target)
        found = one[rows, target // SIDE] + two[rows, target % SIDE]
        return found - log_sums(one) - log_sums(two)

    def backward(self, context: list[np.ndarray], target: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradient of the mean negative log probability but for the
        embedding, and by the hidden layer's input."""
        p, n, rows = self.parameters, len(target), np.arange(len(target))
        hidden = self.hidden(context)
        one, two = map(softmax, self.scores(hidden, target))
        one[rows, target // SIDE] -= 1
        two[rows, target % SIDE] -= 1
        one /= n
        two /= n
        back = one @ p["classes"].T
        back += two @ p["places"].T
        which, place_bias = row_sums(target // SIDE, two)
        whole = np.zeros_like(p["place_bias"])
        whole[which] = place_bias
        found = {"classes": hidden.T @ one, "class_bias": one.sum(axis=0), "places": hidden.T @ two, "place_bias": whole}
        hidden *= hidden
        back -= back * hidden
        return found | {"hidden": back.sum(axis=0)}, back

    def gradient(self, context: list[np.ndarray], target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log probability."""
        found, back = self.backward(context, target)
        embedding = np.zeros_like(self.parameters["embedding"])
        for k, c in enumerate(context):
            rows, sums = row_sums(c, back)
            embedding[k][rows] = sums
        return found | {"embedding": embedding}

    def step(self, squares: dict[str, np.ndarray], context: list[np.ndarray], target: np.ndarray) -> None:
        """One step of AdaGrad; where the gradient is 0 nothing moves, so only
        the embeddings in ``context`` are read."""
        found, back = self.backward(context, target)
        for name, g in found.items():
            squares[name] += g * g
            self.parameters[name] -= RATE * g / np.sqrt(squares[name])
        for k, c in enumerate(context):
            rows, g = row_sums(c, back)
            own = squares["embedding"][k][rows] + g * g
            squares["embedding"][k][rows] = own
            self.parameters["embedding"][k][rows] -= RATE * g / np.sqrt(own)


def row_sums(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indices, and the sums of their rows of ``values``."""
    order = np.argsort(index.astype(np.int16), kind="stable")
    found = index[order]
    begins = np.flatnonzero(np.diff(found, prepend=-1))
    return found[begins], np.add.reduceat(values.take(order, axis=0), begins, axis=0)


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def log_sums(x: np.ndarray) -> np.ndarray:
    """log of the summed exponentials of each row; ``x`` is overwritten."""
    top = x.max(axis=1)
    x -= top[:, None]
    return top + np.log(np.exp(x, out=x).sum(axis=1))


def padded(ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with two zeros around each text, and where each id is."""
    reach = max(CONTEXT)
    places = np.arange(len(ids)) + reach * (1 + np.cumsum(np.diff(owner, prepend=owner[:1]) > 0))
    row = np.zeros(int(places[-1]) + reach + 1 if len(ids) else reach, np.int32)
    row[places] = ids
    return row, places


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents, lower-cased."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=TEXT_SLICE):
                words = split(part.column("text"))
                n = np.bincount(words.codes, minlength=len(words.distinct))
                yield pa.RecordBatch.from_arrays([pa.array(words.distinct, pa.string()), pa.array(n)],
                                                 names=["word", "n"])

    return map_arrow(docs.select("text"), run, "word string, n bigint").filter("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word_counts`` as a table."""
    return written(word_counts(docs.select(F.col(text_col).alias("text"))), "word-counts")


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> Network:
    counts = counted(docs) if counts is None else counts
    top = [tuple(r) for r in counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    rest = [0] * HASHED
    for bucket, n in counts.groupBy((F.crc32(F.col("word").cast("binary")) % HASHED).alias("bucket")).agg(F.sum("n")).collect():
        rest[bucket] = n
    common = counts.filter(F.col("n") > sum(rest) // COMMON).collect()
    for word, n in top:
        rest[zlib.crc32(word.encode()) % HASHED] -= n
    network = Network.start([w for w, _ in top], [n for _, n in top], rest)
    network.common = {w: math.log(n / rest[zlib.crc32(w.encode()) % HASHED]) for w, n in common if w not in network.vocabulary}
    return network


def train_round(docs: DataFrame, network: Network, number: int) -> Network:
    """One pass over ``docs(text)`` in every task, then the weighted mean."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(network)
    sizes = [int(np.prod(s)) for s in SHAPES.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        own = replace(start, parameters={k: v.copy() for k, v in start.parameters.items()})
        squares = {k: np.full_like(v, 1e-6) for k, v in own.parameters.items()}
        seen = 0
        for batch in batches:
            for part in slices(batch, max_bytes=TEXT_SLICE):
                words = split(part.column("text"))
                row, places = padded(own.ids(words), words.owner)
                for offset in range(number, number + MASK_EVERY):
                    masked = places[offset % MASK_EVERY::MASK_EVERY]
                    for at in np.array_split(masked, len(masked) // BATCH + 1):
                        if len(at):
                            own.step(squares, [row.take(at + k) for k in CONTEXT], row.take(at))
                seen += len(places)
        if seen:
            flat = np.concatenate([own.parameters[k].ravel() for k in SHAPES]).astype(np.float64) * seen
            parts = np.array_split(flat, -(-len(flat) // CHUNK))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.list_(pa.float64())),
                                              pa.array(np.full(len(parts), seen))], names=["chunk", "weighted", "words"])

    sums = (map_arrow(docs.select("text"), run, _SUMS).repartition("chunk").mapInArrow(summed, _SUMS)
            .toArrow().sort_by("chunk"))
    if not len(sums):
        return network
    means = sums.column("weighted").combine_chunks().flatten().to_numpy() / sums.column("words")[0].as_py()
    parts = np.split(means.astype(np.float32), np.cumsum(sizes)[:-1])
    return replace(network, parameters={k: x.reshape(s) for (k, s), x in zip(SHAPES.items(), parts)})


_SUMS = "chunk int, weighted array<double>, words bigint"


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each chunk's rows, which meet in one partition."""
    totals: dict[int, list] = {}
    for b in batches:
        for chunk, values, words in zip(b.column("chunk").to_pylist(), b.column("weighted"), b.column("words").to_pylist()):
            total = totals.setdefault(chunk, [0.0, 0])
            total[0] = total[0] + values.values.to_numpy()
            total[1] += words
    if totals:
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([v for v, _ in totals.values()], pa.list_(pa.float64())),
                                          pa.array([n for _, n in totals.values()])], names=["chunk", "weighted", "words"])


def train(docs: DataFrame, counts: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> Network:
    rows = docs.select(F.coalesce(F.pmod(F.xxhash64(id_col), F.lit(ROUNDS)), F.lit(0)).alias("fold"), F.col(text_col).alias("text"))
    network = vocabulary(rows, counts)
    for k in range(ROUNDS):
        network = train_round(rows.filter(F.col("fold") == k), network, k)
    return network


def score(docs: DataFrame, network: Network, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of every row's whole text,
    by the network and the ``counts`` it comes from."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, max_bytes=TEXT_SLICE):
                words = split(part.column("text"))
                total, n = log_probabilities(shared.value, words)
                shares, rare = word_shares(shared.value, words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(n))), part.column("doc_id"), pa.array(n), pa.array(total + shares), rare],
                    names=["row_id", "doc_id", "n_words", "known", "rare"])
                row += len(n)

    rows = written(map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                             "row_id bigint, doc_id bigint, n_words bigint, known double, "
                             "rare array<struct<word:string,times:bigint>>"), "word-scores")
    bucket = F.get(F.array(*[F.lit(float(max(n, 1))) for n in network.hashed]), (F.crc32(F.col("word").cast("binary")) % HASHED).cast("int"))
    rest = (rows.select("row_id", F.inline("rare")).join(counts, "word", "left").groupBy("row_id")
            .agg(F.sum(F.col("times") * F.log(F.coalesce("n", F.lit(1)) / bucket)).alias("rest")))
    total = F.col("known") + F.coalesce("rest", F.lit(0.0))
    return (rows.drop("rare").join(rest, "row_id", "left")
            .select("doc_id", "n_words", total.alias("log_prob"), (total / F.greatest("n_words", F.lit(1))).alias("mean_log_prob")))


def word_shares(network: Network, words: Words) -> tuple[np.ndarray, pa.Array]:
    """Summed log(n(word) / n(bucket)) of each text's common words, and its
    other words of buckets with how often they occur."""
    low = words.distinct
    share = np.fromiter((0.0 if w in network.vocabulary else network.common.get(w, np.nan) for w in low), float, len(low))
    rare = np.isnan(share)[words.codes]
    total = np.bincount(words.owner[~rare], share[words.codes[~rare]], words.texts)
    pairs, times = np.unique(words.owner[rare] * len(low) + words.codes[rare], return_counts=True)
    owner, code = np.divmod(pairs, max(len(low), 1))
    items = pa.StructArray.from_arrays([pa.array(low, pa.string()).take(pa.array(code)), pa.array(times, pa.int64())], names=["word", "times"])
    ends = np.cumsum(np.bincount(owner, minlength=words.texts))
    return total, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), items)


def log_probabilities(network: Network, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Summed log probability of the ids and number of words of each text."""
    row, places = padded(network.ids(words), words.owner)
    logp = np.zeros(len(places))
    for lo in range(0, len(places), RUN):
        at = places[lo:lo + RUN]
        logp[lo:lo + RUN] = network.forward([row.take(at + k) for k in CONTEXT], row.take(at))
    return np.bincount(words.owner, logp, words.texts), np.bincount(words.owner, minlength=words.texts)
