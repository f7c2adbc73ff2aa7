import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwell.llm import lm_score
from inkwell.llm.queries import op10
from tests.llm.helpers import documents, save


def slow_score(network, text):
    """Word by word, from the definition."""
    words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    ids = [network.vocabulary.get(w, 1024 - 256 + zlib.crc32(w.encode()) % 256) for w in words]
    p, total = {k: v.astype(float) for k, v in network.parameters.items()}, 0.0
    for i, target in enumerate(ids):
        around = [ids[i + k] if 0 <= i + k < len(ids) else 0 for k in (-2, -1, 1, 2)]
        hidden = [math.tanh(p["hidden"][j] + sum(p["embedding"][k][c][j] for k, c in enumerate(around))) for j in range(lm_score.HIDDEN)]
        one = np.array(hidden) @ p["classes"] + p["class_bias"]
        two = np.array(hidden) @ p["places"] + p["place_bias"][target // 32]
        total += one[target // 32] - np.log(np.exp(one).sum()) + two[target % 32] - np.log(np.exp(two).sum())
    return total, len(ids)


def corpus(n=300, seed=1):
    """Two kinds of documents whose neighbouring words predict each other."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = (["red", "green", "blue"], ["car", "bus", "tram"]) if i % 2 else (["one", "two", "three"], ["hill", "lake", "sea"])
        rows.append((i, " ".join(f"{x} {b[a.index(x)]} of" for x in rnd.choices(a, k=rnd.randint(5, 40)))))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    return lm_score.train(documents(spark, corpus()))


def test_scores_against_the_definition(trained, monkeypatch):
    texts = ["red car of one", "", None, "x", "Unknown words Red of of", " lead  and\ttrail \n", "of " * 50]
    for run in (1 << 16, 7):
        monkeypatch.setattr(lm_score, "RUN", run)
        total, n = lm_score.log_probabilities(trained, lm_score.split(pa.array(texts)))
        want = [slow_score(trained, t) for t in texts]
        assert n.tolist() == [w for _, w in want]
        np.testing.assert_allclose(total, [s for s, _ in want], rtol=1e-4, atol=1e-4)


def test_probabilities_sum_to_one(trained):
    context = [np.full(lm_score.IDS, c, np.int32) for c in (5, 9, 0, 1000)]
    logp = trained.forward(context, np.arange(lm_score.IDS))
    assert np.exp(logp.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_gradient_against_differences():
    network = lm_score.Network.start(["a"], [3], [1] * lm_score.HASHED)
    network.parameters = {k: v.astype(float) for k, v in network.parameters.items()}
    rng = np.random.default_rng(0)
    context, target = [rng.integers(0, 1024, 6) for _ in range(4)], rng.integers(1, 1024, 6)
    found = network.gradient(context, target)
    for name, value in network.parameters.items():
        flat, g = value.ravel(), found[name].ravel()
        for i in {*np.argsort(-np.abs(g))[:3].tolist(), 0}:
            was, h = flat[i], 1e-5
            flat[i] = was + h
            up = -network.forward(context, target).mean()
            flat[i] = was - h
            down = -network.forward(context, target).mean()
            flat[i] = was
            assert g[i] == pytest.approx((up - down) / 2 / h, abs=1e-6)


def test_training_beats_unigrams_and_word_order_counts(spark, trained):
    unseen = [t for _, t in corpus(60, seed=2)]
    rows = documents(spark, corpus()).select(F.lit(0).alias("fold"), "text")
    unigram = lm_score.vocabulary(rows)
    score = lambda net, texts: lm_score.log_probabilities(net, lm_score.split(pa.array(texts)))[0].sum()
    assert score(trained, unseen) > 0.6 * score(unigram, unseen)
    rnd = random.Random(3)
    shuffled = [" ".join(rnd.sample(t.split(), len(t.split()))) for t in unseen]
    assert score(trained, shuffled) < 1.3 * score(trained, unseen)


def test_counts_cover_every_document(spark):
    rows = corpus(40) + [(90, None), (91, "RED red Red")]
    got = {r["word"]: r["n"] for r in lm_score.word_counts(documents(spark, rows)).collect()}
    want = {}
    for _, t in rows:
        for w in (t or "").lower().split():
            want[w] = want.get(w, 0) + 1
    assert got == want


def test_query_and_defined_cases(spark, tmp_path):
    rows = [*corpus(30), (None, "red car of"), (100, None), (101, ""), (102, "of " * 200_000), (103, "red"), (103, "red")]
    df = documents(spark, rows, fold="1", n_words="2", log_prob="3", word="4", n="5")
    got = op10(spark, save(spark, tmp_path, documents=df)).collect()
    assert len(got) == len(rows) and all(r["log_prob"] <= 0 and not math.isnan(r["log_prob"]) for r in got)
    assert {(r["n_words"], r["log_prob"], r["mean_log_prob"]) for r in got if r["doc_id"] in (100, 101)} == {(0, 0.0, 0.0)}
    assert [r["n_words"] for r in got if r["doc_id"] == 102] == [200_000]
    assert len({r["log_prob"] for r in got if r["doc_id"] == 103}) == 1
    assert op10(spark, save(spark, tmp_path / "none", documents=df.limit(0))).count() == 0


def bucketed():
    """More words than ids, as often as their number says, in one document
    each; two of one bucket."""
    rows = [(i, " ".join([f"word{i}"] * (2 + i % 3))) for i in range(lm_score.FREQUENT + 700)]
    return rows, {f"word{i}": 2 + i % 3 for i, _ in rows}


@pytest.mark.parametrize("common", [10, 1 << 40])
def test_every_word_has_its_own_probability(spark, tmp_path, monkeypatch, common):
    monkeypatch.setattr(lm_score, "COMMON", common)
    rows, n = bucketed()
    docs = documents(spark, rows)
    network = lm_score.train(docs)
    bucket = {w: zlib.crc32(w.encode()) % 256 for w in n}
    of_bucket = {b: sum(n[w] for w in n if bucket[w] == b and w not in network.vocabulary) for b in bucket.values()}
    got = {r["doc_id"]: r for r in op10(spark, save(spark, tmp_path, documents=docs)).collect()}
    ids = dict(zip([i for i, _ in rows], lm_score.log_probabilities(network, lm_score.split(pa.array([t for _, t in rows])))[0]))
    hashed = [i for i, _ in rows if f"word{i}" not in network.vocabulary]
    assert len(hashed) == 700
    for i, _ in rows:
        w = f"word{i}"
        own = 0 if w in network.vocabulary else n[w] * math.log(n[w] / of_bucket[bucket[w]])
        assert got[i]["log_prob"] == pytest.approx(ids[i] + own, rel=1e-4)
        assert got[i]["mean_log_prob"] == pytest.approx(got[i]["log_prob"] / n[w])


def test_every_word_is_a_target_once(spark, monkeypatch):
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(30))) for i in range(12)]
    network = lm_score.vocabulary(documents(spark, rows))
    targets = []
    monkeypatch.setattr(lm_score.Network, "step", lambda self, squares, context, target: targets.extend(target.tolist()))
    monkeypatch.setattr(lm_score, "map_arrow", lambda df, run, schema: list(run(df.toArrow().to_batches())) and spark.createDataFrame(
        [], schema))
    lm_score.train_round(documents(spark, rows), network, 1)
    assert sorted(targets) == sorted(network.vocabulary[f"t{i}x{k}"] for i in range(12) for k in range(30))


def test_words_are_split_as_everywhere():
    texts = [None, "", " ", "oNe É", " a  b\tc\x0b", "x\x1cy \u00a0 z", "é a", "b", "a\r\n", "\x00 \x85"]
    for part in (pa.array(texts), pa.array(texts).slice(3, 5), pa.array(texts).slice(0, 0)):
        fast, plain = lm_score.split(part), lm_score.Words.of(part)
        assert [fast.distinct[c] for c in fast.codes] == [plain.distinct[c].lower() for c in plain.codes]
        assert fast.owner.tolist() == plain.owner.tolist() and fast.texts == plain.texts
