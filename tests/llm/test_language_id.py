import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from inkwell.llm import language_id
from inkwell.llm.common import text_buffer
from inkwell.llm.queries import op4
from tests.llm.helpers import documents, save

SF = "/root/testdata/sf0.01"


def fold(text):
    return b"\0\0\0" + bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())


def slow_counts(texts):
    trees = [defaultdict(Counter) for _ in range(4)]
    for t in texts:
        b = fold(t)
        for i in range(3, len(b)):
            for k in range(4):
                trees[k][b[i - k:i]][b[i]] += 1
    return trees


def slow_p(trees, context, byte, k=3):
    """Probability of ``byte`` after ``context``, by recursion over the orders."""
    if k < 0:
        return 1 / (256 - 26)
    counts = trees[k].get(context[len(context) - k:])
    if not counts:
        return slow_p(trees, context, byte, k - 1)
    total, distinct = sum(counts.values()), len(counts)
    if byte in counts:
        return counts[byte] / (total + distinct)
    free = 1 - sum(slow_p(trees, context, b, k - 1) for b in counts)
    return distinct / (total + distinct) * slow_p(trees, context, byte, k - 1) / free


def slow_bits(trees, text):
    b = fold(text)
    return -sum(math.log2(slow_p(trees, b[i - 3:i], b[i])) for i in range(3, len(b)))


TRAIN = {"x": ["abra cadabra", "Abracadabra!", "a"], "y": ["été là-bas", "été"]}


def model_of(train):
    grams = Counter()
    for lang, texts in train.items():
        for t in texts:
            b = fold(t)
            for i in range(3, len(b)):
                grams[lang, int.from_bytes(b[i - 3:i + 1], "big")] += 1
    langs = sorted(train)
    return language_id.build(langs, [langs.index(k[0]) for k in grams], [k[1] for k in grams], list(grams.values()))


@pytest.mark.parametrize("run", [1 << 20, 3])
def test_code_lengths_against_recursion(run):
    model = model_of(TRAIN)
    texts = ["abra", "Été", "", "zq~", "abracadabra là", "a", "", "BRA 漢"]
    got = model.code_lengths(*text_buffer(pa.array(texts)), run=run)
    want = [[slow_bits(slow_counts(TRAIN[x]), t) for x in model.languages] for t in texts]
    np.testing.assert_allclose(got, want, rtol=1e-5, atol=1e-4)


def test_probabilities_of_a_context_sum_to_one():
    model = model_of(TRAIN)
    p = np.exp2(-model.bits.astype(float)).reshape(-1, model.symbols, len(model.languages))
    seen = model.symbols - 2
    total = p[:, 2:].sum(axis=1) + (256 - 26 - seen) * p[:, 1]
    np.testing.assert_allclose(total, 1, rtol=1e-5)


def test_held_out_accuracy(spark):
    import os
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    got = op4(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and {r["doc_id"] for r in held} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_defined_cases(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(["the", "of", "and", "with"], k=30)), "en") for i in range(20)]
    rows += [(i + 20, " ".join(rnd.choices(["der", "und", "nicht", "für"], k=30)), "de") for i in range(20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34 !", "en"), (103, "der und nicht", None),
             (None, "the of the", "xx"), (104, "the and of " * 60_000, None), (105, "of the"), (105, "of the")]
    df = documents(spark, rows, lang_pred="a", score="b", letters="c", held_out="d")
    got = [tuple(r) for r in op4(spark, save(spark, tmp_path, documents=df)).collect()]
    by = {r[0]: r for r in got}
    assert len(got) == len(rows) and {by[i][2:] for i in (100, 101, 102)} == {("und", 0.0)}
    assert by[103][2] == "de" and by[104][2] == "en" and by[None][1:3] == (False, "en")
    assert [r for r in got if r[0] == 105][0] == [r for r in got if r[0] == 105][1]
    model = language_id.train(df)
    assert model.languages == ["de", "en"]
    kept = language_id.keep_identified(df, model, 0.5)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {100, 101, 102}
    assert op4(spark, save(spark, tmp_path / "none", documents=df.limit(0))).count() == 0
    unlabelled = documents(spark, [(1, "abc"), (2, "def")])
    assert {r["lang_pred"] for r in op4(spark, save(spark, tmp_path / "un", documents=unlabelled)).collect()} == {"und"}
