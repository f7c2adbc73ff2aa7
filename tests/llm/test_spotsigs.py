import hashlib
import random
import re
import unicodedata

import pytest

from inkwell.llm import neighbours, spotsigs
from inkwell.llm.queries import op2
from tests.llm.helpers import documents, save


def slow_set(text):
    """Signatures as tuples of words."""
    lowered = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in text.lower())
    words, anchors = lowered.split(), set(spotsigs.ANCHORS)
    out = set()
    for i, w in enumerate(words):
        if w in anchors:
            chain = [x for x in words[i + 1:] if x not in anchors][:2]
            if len(chain) == 2:
                out.add((w, *chain))
    return out or {(" ".join(words),)}


def slow_likeness(a, b):
    a, b = slow_set(a), slow_set(b)
    return len(a & b) / len(a | b)


def texts(n, seed=4):
    rnd = random.Random(seed)
    words = ["the", "of", "la", "und", "cat", "Dog", "tree,", "ñu", "été", "x1", "grün.\n", "a"]
    out = [None, "", "  \t", "the", "the cat", "the of cat dog", "cat dog tree", "THE Cat; dog"]
    while len(out) < n:
        base = rnd.choices(words, k=rnd.choice([3, 20, 200]))
        out.append(" ".join(base))
        out.append(" ".join(base[:-1] + [rnd.choice(words)]))
    return out[:n]


def test_query_against_brute_force(spark, tmp_path):
    rows = list(zip(random.Random(1).sample(range(-500, 10**9), 60), texts(60)))
    sf = save(spark, tmp_path, documents=documents(spark, rows, key="1", bucket="2", own="3", edited="4", ghost="5"))
    got = {r["doc_id"]: r for r in op2(spark, sf).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(slow_likeness(text, edited))
        assert r["near_next"] == pytest.approx(slow_likeness(text, following))
        assert len(r["fingerprint"].split(",")) == len(slow_set(text))
        assert len(r["edited_fingerprint"].split(",")) == len(slow_set(edited))


def test_nulls_ties_long_texts_and_empty(spark, tmp_path):
    long = "the cat and the dog of a house " * 12_000
    df = documents(spark, [(5, "b"), (5, "a"), (None, "z"), (None, None), (None, "y"), (1, long), (1, long), (7, "the cat dog")])
    got = op2(spark, save(spark, tmp_path, documents=df)).collect()
    assert len(got) == 8 and sum(r["n_chars"] == len(long) for r in got) == 2
    assert len({r["fingerprint"] for r in got if r["n_chars"] == len(long)}) == 1
    assert {r["near_next"] for r in got if r["n_chars"] == len(long)} == {0.0, 1.0}
    one = op2(spark, save(spark, tmp_path / "one", documents=df.filter("doc_id = 7"))).collect()
    assert [(r["near_edited"], r["near_next"]) for r in one] == [(pytest.approx(slow_likeness("the cat dog", "the catthe")), 1.0)]
    assert op2(spark, save(spark, tmp_path / "none", documents=df.limit(0))).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 50, 1000])
def test_bucket_of_counts_the_bounds(spark, size):
    bounds = sorted(random.Random(size).sample(range(-2000, 2000), size))
    keys = [*range(-2005, 2005, 7), *bounds]
    df = spark.createDataFrame([(k,) for k in keys], "key bigint")
    from pyspark.sql import functions as F
    for r in df.select("key", neighbours.bucket_of(F.col("key"), bounds).alias("b")).collect():
        assert r["b"] == sum(b <= r["key"] for b in bounds)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_similar_pairs_against_all_pairs(spark, threshold):
    rnd = random.Random(int(threshold * 10))
    sets = []
    for _ in range(25):
        base = rnd.sample(range(60), rnd.randint(1, 25))
        sets += [sorted(base), sorted(set(base[:-1]) | {rnd.randrange(60)}), sorted(base[:max(1, len(base) * 4 // 5)])]
    sets = [list(s) for s in sorted(set(map(tuple, sets)))]
    df = spark.createDataFrame(list(enumerate(sets)), "id bigint, signatures array<bigint>")
    got = {(r["a"], r["b"]): r["likeness"] for r in spotsigs.similar_pairs(df, threshold).collect()}
    want = {(i, j): len(set(x) & set(y)) / len(set(x) | set(y)) for i, x in enumerate(sets) for j, y in enumerate(sets)
            if i < j and len(set(x) & set(y)) / len(set(x) | set(y)) >= threshold}
    assert got == pytest.approx(want)


def test_pruned_likeness(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([([1, 2, 3, 4], [1]), ([1, 2, 3, 4], [1, 2, 3])], "a array<bigint>, b array<bigint>")
    got = [tuple(r) for r in df.select(spotsigs.likeness(F.col("a"), F.col("b")), spotsigs.likeness(F.col("a"), F.col("b"), 0.5)).collect()]
    assert got == [(0.25, 0.0), (0.75, 0.75)]
