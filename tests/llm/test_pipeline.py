import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from inkwell.llm import mixing, simhash
from inkwell.llm.settings import OTHER_WEIGHT, TARGET_WEIGHTS, tokenizer_path
from tests.llm.helpers import documents, save
from tests.llm.test_pii import slow_base
from tests.llm.test_simhash import slow_components, slow_fingerprint


def corpus(n=120):
    rnd = random.Random(11)
    kinds = {"en": ["the", "of", "and", "with", "house", "tree", "Water"], "de": ["der", "und", "nicht", "für", "Haus", "Baum", "über"]}
    rows = []
    for i in range(n):
        lang = rnd.choice(list(kinds))
        words = rnd.choices(kinds[lang], k=rnd.choice([12, 60, 200])) + [f"w{i}", f"v{i}"]
        if i % 9 == 0:
            words[5] = rnd.choice(["me@mail.example.com", "4111 1111 1111 1111", "+1 (609) 555-7932", "10.20.30.40"])
        rows.append((i, " ".join(words), lang, f"src{rnd.choice([0, 0, 0, 1, 2, 17])}"))
    rows += [(200 + k, rows[k][1], rows[k][2], "src5") for k in range(20)]
    rows += [(300, None, "en", None), (301, "", None, "src1"), (302, "12 34", "en", "src1"), (303, rows[4][1], None, None)]
    return rows


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus()
    docs = documents(spark, rows, row="1", fingerprint="2", n="3")
    sf = save(spark, tmp_path, documents=docs)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash", "pii", "mixing", "packing"]
    results = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        results.append(spark.read.parquet(f"{tmp_path}/{name}"))
        docs = results[-1]
    identified, distinct, redacted, mixed, pieces = results
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert all(r.columns == columns for r in results[:-1])

    kept = {r[0]: r[1] for r in rows if r[0] not in (300, 301, 302)}
    assert {r["doc_id"]: r["text"] for r in identified.collect()} == kept

    ids = sorted(kept)
    comp = slow_components([slow_fingerprint(kept[i]) for i in ids], 2)
    first = {ids[c] for c in comp}
    assert {r["doc_id"]: r["text"] for r in distinct.collect()} == {i: kept[i] for i in first}
    assert len(first) < len(kept)

    for r in redacted.collect():
        was = kept[r["doc_id"]]
        if slow_base(was):
            assert not slow_base(r["text"]) and re.search(r"\[[A-Z]+\]", r["text"])
        else:
            assert r["text"] == was

    assert plain(mixed) == plain(redacted)
    plan = mixing.mix(redacted, TARGET_WEIGHTS, OTHER_WEIGHT).orderBy("slot", "place").collect()
    files = sorted((tmp_path / "mixing").glob("part-*"))
    order = [i for f in files for i in spark.read.parquet(str(f)).toPandas()["doc_id"]]
    assert order == [r["doc_id"] for r in plan]

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    tokens = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    for r in pieces.collect():
        part = tokens[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(r["length"] for r in pieces.collect()) == sum(map(len, tokens.values()))
    assert plain(corpus_pipeline.run(spark, sf)) == plain(pieces)


def test_dedup_of_rows_without_ids_and_repeats(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (None, "x y z w"), (5, "x y z w"), (5, "x y z w"), (9, "X Y Z W"),
            (5, "other words here"), (None, None)]
    got = simhash.deduplicate(documents(spark, rows, label="l", id="i", fp="f"), 3, 2).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(
        [(None, "a b c d"), (5, "x y z w"), (5, "other words here"), (None, None)], key=str)


def test_empty_table_passes_every_stage(spark, tmp_path):
    sf = save(spark, tmp_path, documents=documents(spark, [(1, "a")]).limit(0))
    assert corpus_pipeline.run(spark, sf).count() == 0


@pytest.mark.parametrize("name", ["op1_licence_scan", "op2_spotsigs", "op3_simhash", "op4_language_id", "op5_quality", "op6_url_filter",
                                  "op7_mixing", "op8_packing", "op9_pii", "op10_lm_score", "pipeline"])
def test_queries_are_registered(name):
    import __spark_entry__

    assert name in __spark_entry__.queries()


def test_packing_follows_the_mixed_stream(spark, tmp_path, monkeypatch):
    docs = documents(spark, [(i, f"word{i} and {i * 7}", "en", f"src{i % 3}") for i in range(100)], file="1", index="2", run="3")
    found = {}
    for name, weights in {"even": TARGET_WEIGHTS, "other": {"src1": 90, "src2": 1}}.items():
        mixing.mixed(docs, weights, OTHER_WEIGHT, 4).write.parquet(f"{tmp_path}/{name}")
        files = sorted((tmp_path / name).glob("part-*"))
        order = [i for f in files for i in spark.read.parquet(str(f)).toPandas()["doc_id"]]
        stream = spark.read.parquet(f"{tmp_path}/{name}")
        run = {r["doc_id"]: r["run"] for r in mixing.runs(stream, ["doc_id"], 8).collect()}
        assert run == {d: k // 8 for k, d in enumerate(order)}
        monkeypatch.setattr(mixing.runs, "__defaults__", (8,))
        pieces = corpus_pipeline.pack(spark, stream, "").orderBy("sequence_id", "offset").collect()
        packed = list(dict.fromkeys(r["doc_id"] for r in pieces))
        assert [run[d] for d in packed] == sorted(run.values())
        found[name] = packed
    assert found["even"] != found["other"]
