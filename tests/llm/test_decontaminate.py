import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from inkwell.llm import decontaminate as dc
from inkwell.llm.queries import op13
from tests.llm.helpers import documents, save


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(docs, items, window=10):
    out = []
    for text in docs:
        w = words(text)
        hit, named = set(), set()
        for name, item in items:
            v = words(item)
            size = min(window, len(v))
            for i in range(len(v) - size + 1 if v else 0):
                for j in range(len(w) - size + 1):
                    if w[j:j + size] == v[i:i + size]:
                        hit |= set(range(j, j + size))
                        named.add(str(name))
        out.append((len(w), len(hit), sorted(named)))
    return out


def corpus(n=60, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["Ab", "c1", "Ünd", "é", "x", "The", "of"]

    def prose(k):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", " -- "]) for _ in range(k))

    items = [(k, prose(rnd.choice([1, 4, 9, 10, 11, 30]))) for k in (2, 10, 1, 7, 30, 11)] + [(5, None), (6, "--"), (8, "")]
    docs = [None, "", "...", "\x00", prose(3), prose(2000)]
    while len(docs) < n:
        base = prose(rnd.choice([0, 5, 40]))
        item = rnd.choice(items)[1] or ""
        docs += [base + item + prose(rnd.choice([0, 7]))] * rnd.choice([1, 1, 3])
    return docs, items


def tables(spark, docs, items):
    return documents(spark, list(enumerate(docs)), spans="x", item_id="y", row_id="z"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("shard_bytes", [60, 1 << 20])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, shard_bytes):
    docs, items = corpus()
    monkeypatch.setattr(dc, "SHARD_BYTES", shard_bytes)
    d, b = tables(spark, docs, items)
    got = {r["doc_id"]: r for r in op13(spark, save(spark, tmp_path, documents=d, benchmark=b)).collect()}
    for k, (n, hit, named) in enumerate(slow(docs, items)):
        sha = hashlib.sha256(",".join(named).encode()).hexdigest()
        assert tuple(got[k]) == (k, n, hit, len(named), sha, hit > 0)
    assert len(got) == len(docs)


def test_passes_give_the_same(spark):
    docs, items = corpus(seed=4)
    d, b = tables(spark, docs, items)
    one = sorted(dc.scan(d, b).select("doc_id", "n_words", "n_hit", "items").collect())
    many = sorted(dc.scan(d, b, test_bytes=40).select("doc_id", "n_words", "n_hit", "items").collect())
    assert one == many
    assert sum(r["n_hit"] > 0 for r in one) > 10
    clean = dc.decontaminate(d, b, test_bytes=40)
    assert clean.columns == d.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [r["doc_id"] for r in one if not r["n_hit"]]


def test_suffix_arrays_are_sorted(spark):
    docs, _ = corpus(seed=5)
    texts = dc.Texts.of(pa.array(docs, pa.string()))
    names = [None, *texts.distinct.to_pylist()]
    assert [[names[c] for c in texts.codes[a:b - 1]] for a, b in zip(texts.begins, texts.begins[1:])] == [words(t) for t in docs]
    for depth in (1, 3, 10, 64):
        order = dc.suffix_array(texts, depth)
        assert sorted(order) == np.flatnonzero(texts.codes).tolist()

        def suffix(at):
            end = texts.begins[np.searchsorted(texts.begins, at, side="right")] - 1
            return texts.codes[at:min(at + depth, end)].tolist()

        keys = [suffix(at) for at in order]
        assert keys == sorted(keys)


def test_longest_matches(spark):
    docs, items = corpus(n=30, seed=6)
    d, b = tables(spark, docs, items)
    expected = set()
    split = [words(t) for t in docs]
    for name, item in items:
        v = words(item)
        for i in range(len(v)):
            runs = []
            for k, w in enumerate(split):
                for j in range(len(w)):
                    n = 0
                    while i + n < len(v) and j + n < len(w) and w[j + n] == v[i + n]:
                        n += 1
                    runs.append((n, k, j))
            best = max(r[0] for r in runs)
            if best >= 5 or i == 0 and best == len(v):
                expected |= {(str(name), i, best, k, j) for n, k, j in runs if n == best}
    for size in (40, dc.TEST_BYTES):
        assert {tuple(r) for r in dc.longest_matches(d, b, 5, test_bytes=size).collect()} == expected


def test_empty_tables(spark):
    docs, items = corpus(n=10)
    d, b = tables(spark, docs, items)
    assert dc.scan(d.limit(0), b).count() == 0
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in dc.scan(d, b.limit(0)).collect())
    assert dc.decontaminate(d, b.limit(0)).count() == d.count()
    assert dc.longest_matches(d, b.limit(0)).count() == 0
    named = spark.createDataFrame([(None, docs[5]), (None, docs[5])], "item_id bigint, text string")
    assert [r["items"] for r in dc.scan(d.filter("doc_id = 5"), named).collect()] == [[""]]
