"""Benchmark decontamination by suffix arrays of the training texts.

Documents are read in shards of whole texts.  The words of a shard become one
array of codes with a mark behind each text, and its suffixes are sorted by
their first words (packed keys, then prefix doubling of what is still tied) as
deep as a test suffix can reach.  Every suffix of every test item is searched
in every shard, word by word, all suffixes at one time: a binary search narrows
its interval of the suffix array until no training text goes on like it, which
is its longest verbatim match, with all locations in the interval.

The test items are a stated query set.  They are dealt to passes of about
``TEST_BYTES`` of text; a pass is broadcast, and each further pass reads the
documents once more.

Words are runs of ASCII letters, digits and other than ASCII characters,
A-Z lower-cased.

Defined results: a null or empty text has no words and is never affected; an
item without words matches nothing; rows with one item_id are one item; a null
item_id counts as an item with an empty name; repeated documents each get
their row; an empty table on either side gives no matches, and every document
stays.  ``scan`` and ``longest_matches`` read only the named columns, so extra
columns never clash; ``decontaminate`` returns all columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import map_arrow, slices, text_buffer, written

#: Words of a window; a shorter item is one window.
WINDOW = 10
#: Text bytes of a shard, and of the test items in one pass.
SHARD_BYTES, TEST_BYTES = 4 << 20, 16 << 20

#: What each byte is in a word; 0 ends the word.
_FOLD = np.zeros(256, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[128:] = range(48, 58), range(97, 123), range(128, 256)
_FOLD[65:91] = range(97, 123)

_SPANS = "spans array<struct<start:bigint,end:bigint>>, items array<string>"


@dataclass
class Texts:
    """Words of a run of texts: ``codes`` from 1 with a 0 behind each text, the
    distinct words they stand for, and where each text begins in ``codes``
    (one more than texts)."""

    codes: np.ndarray
    distinct: pa.Array
    begins: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Texts:
        buf, offsets = text_buffer(column)
        at = offsets - offsets[0]
        folded = _FOLD[buf[offsets[0]:offsets[-1]]]
        inside = folded > 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        starts = at[:-1][at[:-1] < len(inside)]
        begin[starts] = inside[starts]
        first = np.flatnonzero(begin)
        places = np.concatenate([np.cumsum(inside)[first] - 1, [np.count_nonzero(inside)]]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(first), pa.py_buffer(places), pa.py_buffer(folded[inside]))
        coded = words.dictionary_encode()
        owner = np.searchsorted(at, first, side="right") - 1
        begins = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(column)) + 1)])
        codes = np.zeros(int(begins[-1]), np.int32)
        codes[np.arange(len(first)) + owner] = coded.indices.to_numpy() + 1
        return Texts(codes, coded.dictionary, begins)

    def counts(self) -> np.ndarray:
        return np.diff(self.begins) - 1


def suffix_array(texts: Texts, depth: int) -> np.ndarray:
    """Positions of all words, sorted by the ``depth`` words from there (to the
    end of their text)."""
    codes = texts.codes
    n = len(codes)
    at = np.flatnonzero(codes)
    if not len(at):
        return at
    bits = int(codes.max()).bit_length()
    span = max(1, min(62 // bits, depth))
    padded = np.concatenate([codes, np.zeros(span, codes.dtype)]).astype(np.int64)
    key = padded[:n]
    for k in range(1, span):
        key = key << bits | padded[k:k + n]
    key = key[at]
    by_key = np.argsort(key)
    order, key = at[by_key], key[by_key]
    left = np.repeat(texts.begins[1:] - 1, np.diff(texts.begins)) - np.arange(n)
    rank = np.zeros(n + 1, np.int64)
    slots, fresh = np.arange(len(order)), np.concatenate([[True], key[1:] != key[:-1]])
    while True:
        group = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[order[slots]] = group + 1
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        tied &= left[order[slots]] >= span
        slots = slots[tied]
        if span >= depth or not len(slots):
            return order
        mine = order[slots]
        key = rank[mine] * (n + 1) + rank[mine + span]
        by_key = np.argsort(key)
        order[slots], key = mine[by_key], key[by_key]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        span *= 2


@dataclass
class Tests:
    """Test items: their words, the item of each, and the item ids."""

    texts: Texts
    ids: list[str]

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, start in its words, and words left of every suffix."""
        n = self.texts.counts()
        item = np.repeat(np.arange(len(n)), n)
        start = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return item, start, n[item] - start

    def windows(self, size: int) -> np.ndarray:
        """Words that each suffix's window has; 0 where no window starts."""
        _, start, left = self.suffixes()
        return np.where(left >= size, size, np.where(start == 0, left, 0))

    def codes_in(self, shard: Texts) -> np.ndarray:
        """The items' words in the shard's codes; -1 is a word it lacks."""
        own = pc.fill_null(pc.index_in(self.texts.distinct, value_set=shard.distinct), -2).to_numpy().astype(np.int64) + 1
        return np.concatenate([[0], own])[self.texts.codes]


def _bound(codes: np.ndarray, low: np.ndarray, high: np.ndarray, word: np.ndarray, beyond: bool) -> np.ndarray:
    """First slot of [low, high) whose code is at least (beyond: over) ``word``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) >> 1
        found = codes(mid, open_)
        right = found <= word[open_] if beyond else found < word[open_]
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]


def search(shard: Texts, order: np.ndarray, tests: Tests, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every test suffix: how many words its longest match has, up to
    ``wanted``, and the slots [low, high) of the suffix array that have it."""
    words = tests.codes_in(shard)
    item, start, _ = tests.suffixes()
    at = tests.texts.begins[item] + start
    ends = np.cumsum(np.bincount(shard.codes, minlength=len(shard.distinct) + 1))
    ends -= ends[0]
    length, low, high = np.zeros((3, len(at)), np.int64)
    alive = np.flatnonzero((wanted > 0) & (words[at] > 0))
    length[alive] = 1
    low[alive], high[alive] = ends[words[at[alive]] - 1], ends[words[at[alive]]]
    depth = 1
    while True:
        alive = alive[(wanted[alive] > depth)]
        alive = alive[words[at[alive] + depth] > 0]
        if not len(alive):
            return length, low, high
        word = words[at[alive] + depth]

        def codes(slots: np.ndarray, _: np.ndarray) -> np.ndarray:
            return shard.codes[order[slots] + depth]

        first = _bound(codes, low[alive], high[alive], word, False)
        last = _bound(codes, first, high[alive], word, True)
        some = first < last
        alive = alive[some]
        low[alive], high[alive] = first[some], last[some]
        depth += 1
        length[alive] = depth


def locations(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(interval, position) of every slot in the intervals."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return which, order[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]]


def occurrences(shard: Texts, tests: Tests, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, position, words) of every occurrence of a test window."""
    wanted = tests.windows(window)
    order = suffix_array(shard, int(wanted.max(initial=0)))
    length, low, high = search(shard, order, tests, wanted)
    whole = np.flatnonzero((wanted > 0) & (length == wanted))
    which, position = locations(order, low[whole], high[whole])
    return tests.suffixes()[0][whole][which], position, wanted[whole][which]


def passes(benchmark: DataFrame, id_col: str, text_col: str, test_bytes: int) -> Iterator[Tests]:
    """The test items in passes of about ``test_bytes`` of text."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, ceil(total / test_bytes))
    items = items.withColumn("pass", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    for k in range(n):
        own = items.filter(F.col("pass") == k).toArrow().combine_chunks()
        column = own.column("text").cast(pa.string())
        text = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        yield Tests(Texts.of(text), own.column("id").to_pylist())


def _lists(owner: np.ndarray, texts: int, items: pa.Array) -> pa.ListArray:
    ends = np.cumsum(np.bincount(owner, minlength=texts))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), items)


def covered(shard: Texts, position: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each place in the shard lies in an occurrence."""
    n = len(shard.codes) + 1
    return (np.cumsum(np.bincount(position, minlength=n) - np.bincount(position + words, minlength=n)) > 0)[:-1]


def _scan_pass(docs: DataFrame, tests: Tests, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(tests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        for batch in batches:
            for part in slices(batch, max_bytes=SHARD_BYTES):
                shard = Texts.of(part.column("text"))
                n = part.num_rows
                item, position, words = occurrences(shard, tests, window)
                hit = covered(shard, position, words).astype(np.int8)
                edges = np.diff(hit, prepend=0, append=0)
                start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                of_span = np.searchsorted(shard.begins, start, side="right") - 1
                spans = pa.StructArray.from_arrays([pa.array(start - shard.begins[of_span]), pa.array(end - shard.begins[of_span])],
                                                   names=["start", "end"])
                of_item = np.searchsorted(shard.begins, position, side="right") - 1
                pairs = np.unique(of_item * len(tests.ids) + item)
                of_pair, named = np.divmod(pairs, max(len(tests.ids), 1))
                names = pa.array(tests.ids, pa.string()).take(pa.array(named))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), part.column("doc_id"), pa.array(shard.counts()), _lists(of_span, n, spans), _lists(of_pair, n, names)],
                    names=["row_id", "doc_id", "n_words", "spans", "items"])

    return map_arrow(docs, run, f"row_id bigint, doc_id bigint, n_words bigint, {_SPANS}")


def merged_words(spans: Column) -> Column:
    """Words in at least one of the spans."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("end"), zero.alias("words"))

    def step(at: Column, s: Column) -> Column:
        gain = F.greatest(s["end"] - F.greatest(s["start"], at["end"]), zero)
        return F.struct(F.greatest(at["end"], s["end"]).alias("end"), (at["words"] + gain).alias("words"))

    return F.aggregate(F.array_sort(spans), start, step, lambda at: at["words"])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", test_bytes: int = TEST_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) of every document: words in
    occurrences of test windows, where they are (word positions, end exclusive;
    overlapping if there are several passes), and the items that occur, sorted
    as strings."""
    tests = list(passes(benchmark, item_col, item_text_col, test_bytes))
    rows = docs.select(F.lit(0).cast("bigint").alias("row_id"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if len(tests) == 1:
        found = _scan_pass(rows, tests[0], window)
    else:
        rows = written(rows.withColumn("row_id", F.monotonically_increasing_id()), "decontaminate-texts")
        each = _scan_pass(rows, tests[0], window)
        for more in tests[1:]:
            each = each.unionByName(_scan_pass(rows, more, window))
        found = each.groupBy("row_id").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return found.select("doc_id", "n_words", merged_words(F.col("spans")).alias("n_hit"), F.array_sort("spans").alias("spans"),
                        F.array_sort(F.array_distinct("items")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", test_bytes: int = TEST_BYTES) -> DataFrame:
    """The documents in which no test window occurs, with all their columns."""
    spark = docs.sparkSession

    def without(docs: DataFrame, tests: Tests) -> DataFrame:
        shared = spark.sparkContext.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col, SHARD_BYTES):
                    shard = Texts.of(part.column(text_col))
                    position = occurrences(shard, shared.value, window)[1]
                    hit = np.bincount(np.searchsorted(shard.begins, position, side="right") - 1, minlength=part.num_rows)
                    yield part.filter(pa.array(hit == 0))

        return map_arrow(docs, run, docs.schema)

    for tests in passes(benchmark, item_col, item_text_col, test_bytes):
        docs = without(docs, tests)
    return docs


def longest_matches(docs: DataFrame, benchmark: DataFrame, min_words: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", test_bytes: int = TEST_BYTES) -> DataFrame:
    """(item_id string, start, words, doc_id, position): for every suffix of an
    item, its longest verbatim match over all shards if it has ``min_words`` or
    more (or the whole item), and every location of that match."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def one_pass(tests: Tests) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            item, start, left = tests.suffixes()
            for batch in batches:
                for part in slices(batch, max_bytes=SHARD_BYTES):
                    shard = Texts.of(part.column("text"))
                    order = suffix_array(shard, int(left.max(initial=0)))
                    length, low, high = search(shard, order, tests, left)
                    long = np.flatnonzero((length >= min_words) | (length > 0) & (start == 0) & (length == left))
                    which, position = locations(order, low[long], high[long])
                    owner = np.searchsorted(shard.begins, position, side="right") - 1
                    of = long[which]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tests.ids, pa.string()).take(pa.array(item[of])), pa.array(start[of]), pa.array(length[of]),
                         part.column("doc_id").take(pa.array(owner)), pa.array(position - shard.begins[owner])],
                        names=["item_id", "start", "words", "doc_id", "position"])

        return map_arrow(rows, run, "item_id string, start bigint, words bigint, doc_id bigint, position bigint")

    each = None
    for tests in passes(benchmark, item_col, item_text_col, test_bytes):
        each = one_pass(tests) if each is None else each.unionByName(one_pass(tests))
    found = written(each, "matches")
    longest = found.groupBy("item_id", "start").agg(F.max("words").alias("words"))
    return found.join(longest, ["item_id", "start", "words"]).distinct()


def oracle(window: int = WINDOW) -> str:
    """DuckDB text of the query: every document window joined to the item windows of its size."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
items AS (SELECT coalesce(item_id::varchar, '') AS item, {words} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT item, w, least(len(w), {window}) AS size, unnest(range(1, len(w) - least(len(w), {window}) + 2)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT r, i, size, item FROM doc_windows JOIN item_windows USING (size, words)),
hit_words AS (
  SELECT r, count(DISTINCT word) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT r, i, size FROM hits)) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""
