import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from inkwell.llm import quality
from inkwell.llm.queries import op5
from tests.llm.helpers import documents, save

SF = "/root/testdata/sf0.01"


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def check(rows, texts):
    for r in rows:
        want = slow_counts(texts[r["doc_id"]])
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == want, texts[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"]) and 0 <= r["probability"] <= 1


def texts(n=200):
    rnd = random.Random(6)
    out = [None, "", " ", "\n\n", "a\x1cb\x85c d", "x " * 9, "x " * 8, "é|<> " * 30, "a b c d e f g h a b c d e f g h i",
           "one\n\none\n \n \none ", " lead and trail "]
    while len(out) < n:
        phrase = [rnd.choice("ab#é") * rnd.randint(1, 3) for _ in range(rnd.randint(5, 12))]
        words = [rnd.choice(["x", "y", "zz", "*"]) for _ in range(rnd.randint(0, 60))] + phrase * rnd.randint(0, 3)
        out.append("".join(w + rnd.choice([" ", "\n", "  ", "\t"]) for w in words))
    return out


def test_counts_against_brute_force(spark, tmp_path):
    rows = dict(enumerate(texts()))
    df = documents(spark, list(rows.items()), n_words="1", kept="2", quality="3", probability="4")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    check(op5(spark, save(spark, tmp_path, documents=df, labels=labels)).collect(), rows)


@pytest.fixture(scope="module")
def judged(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    return op5(spark, SF).join(docs, "doc_id").join(labels, "doc_id", "left").collect()


def test_whole_table_against_brute_force(judged):
    check([r for r in judged if r["doc_id"] % 3 == 0], {r["doc_id"]: r["text"] for r in judged})


def test_labelled_rows_are_told_apart(judged):
    known = [r for r in judged if r["quality"] is not None]
    good = [r["probability"] for r in known if r["quality"]]
    bad = [r["probability"] for r in known if not r["quality"]]
    assert np.mean([b > p for p in bad[:50] for b in good]) > 0.8
    assert np.mean([r["kept"] for r in known if r["quality"] and not r["base_failed"]]) > 0.97


def test_features_of_slices_are_those_of_single_texts():
    some = [t for t in texts(60)]
    whole = pa.array(some, pa.string())
    together = sorted((int(o), int(f)) for owner, feature in quality.features(whole, quality.Words.of(whole)) for o, f in zip(owner, feature))
    alone = []
    for i, t in enumerate(some):
        one = pa.array([t], pa.string())
        alone += [(i, int(f)) for _, feature in quality.features(one, quality.Words.of(one)) for f in feature]
    assert together == sorted(alone)


def test_platt_recovers_a_line():
    rnd = np.random.default_rng(3)
    score = rnd.normal(size=20_000)
    slope, intercept = quality.platt(score, rnd.random(20_000) < 1 / (1 + np.exp(-(2 * score + 1))))
    assert slope == pytest.approx(2, abs=0.1) and intercept == pytest.approx(1, abs=0.1)


def test_defined_cases(spark, tmp_path):
    df = documents(spark, [(None, "a b"), (1, "word " * 200_000), (1, "word " * 200_000), (2, None)])
    none = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = op5(spark, save(spark, tmp_path, documents=df, labels=none)).collect()
    assert sorted((r["n_words"], r["n_repeat_words"], r["probability"]) for r in rows) == [
        (0, 0, 1.0), (2, 0, 1.0), (200_000, 200_000, 1.0), (200_000, 200_000, 1.0)]
    assert op5(spark, save(spark, tmp_path / "none", documents=df.limit(0), labels=none)).count() == 0
