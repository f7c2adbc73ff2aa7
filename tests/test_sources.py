"""Sources and sinks (A1-A8) on small hand-written fixtures; streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.plans.features import enrich_files
from inkwell.sources import small_files
from inkwell.sources.articles import _scan_listed_by_driver, scan_articles, scan_articles_filtered
from inkwell.sources.document_sink import write_documents
from inkwell.sources.files import scan_word_vectors, write_word2vec_text
from inkwell.sources.snapshot import topic_snapshot_refresh
from inkwell.streaming.enrich_stream import enrich_stream


def _doc(uri, headline, text):
    return {"metadata": {"locators": {"assetUri": uri}, "lastPublished": 1353921092,
                         "tags": {"about": [{"thingLabel": "Brexit", "thingId": "t1"}]}},
            "promo": {"headlines": {"headline": headline}, "summary": "s"},
            "content": {"blocks": [{"type": "paragraph", "text": text}]}}


def _write_corpus(root):
    os.makedirs(os.path.join(root, "sub"), exist_ok=True)
    files = {"12345678": _doc("/news/uk-12345678", "One", "Body one."),
             "sub/23456789.JSON": _doc("/sport/football/23456789", "Two", "Body two!"),
             "34567890.json": _doc("/news/34567890", "Three", "Body three.")}
    for name, doc in files.items():
        with open(os.path.join(root, name), "w") as fo:
            json.dump(doc, fo, indent=2)           # one multi-line document per file
    return files


def test_scan_one_document_per_file(spark, tmpdir_path):
    _write_corpus(tmpdir_path)
    df = scan_articles(spark, tmpdir_path)
    assert df.count() == 3
    assert sorted(r["headline"] for r in df.select("promo.headlines.headline").collect()) == ["One", "Three", "Two"]
    assert all(r["path_key"].startswith("file:") for r in df.select("path_key").collect())


ODD = {"object": '{"a": 1, "b": {"c": "x"}}', "array": '[{"a": 1}, {"a": 2}]', "null in it": '[{"a": 1}, null]', "none": "[]", "empty": "",
       "blank": " \n", "cut": '{"a": 1, "b": {"c"', "word": "x", "number": "5", "partly": '{"a": "no", "b": {"c": "y"}}', "two": '{"a": 1}\n{"a": 2}',
       "mark": "\ufeff" + '{"a": 3}', "é [x]%20;.json": '{"a": 4}', "_hidden": '{"a": 5}', ".dot": '{"a": 6}', "s/t/object": '{"a": 7}',
       "s/u/object": '{"a": 8}', "_h/object": '{"a": 9}', "_p=1/object": '{"a": 10}'}


@pytest.mark.parametrize("listed, large", [(10_000, 1 << 20), (2, 1 << 20), (10_000, 20)])
def test_scan_lists_by_tasks_what_the_reader_lists(spark, tmpdir_path, monkeypatch, listed, large):
    for name, text in ODD.items():
        os.makedirs(os.path.dirname(os.path.join(tmpdir_path, name)), exist_ok=True)
        with open(os.path.join(tmpdir_path, name), "w") as fo:
            fo.write(text)
    with open(os.path.join(tmpdir_path, "wide"), "wb") as fo:
        fo.write('{"a": 11}'.encode("utf-16"))
    monkeypatch.setattr(small_files, "LISTED", listed)
    monkeypatch.setattr(small_files, "LARGE", large)
    schema = T.StructType.fromDDL("a int, b struct<c: string>")
    for path, glob in [(tmpdir_path, None), (f"file://{tmpdir_path}/", "*[t5].{j,}*"), ([tmpdir_path, f"{tmpdir_path}/s", f"{tmpdir_path}/word"], None)]:
        want = _scan_listed_by_driver(spark, path, schema, True, glob).collect()
        assert sorted(map(str, scan_articles(spark, path, schema, path_glob=glob).collect())) == sorted(map(str, want))


def test_scan_keeps_no_file_list_in_the_plan(spark, tmpdir_path, monkeypatch):
    for i in range(60):
        os.makedirs(f"{tmpdir_path}/{i}")
        with open(f"{tmpdir_path}/{i}/article.json", "w") as fo:
            fo.write('{"a": %d}' % i)
    monkeypatch.setattr(small_files, "LISTED", 5)
    df = scan_articles(spark, tmpdir_path, T.StructType.fromDDL("a int"))
    assert not [f for f in df.inputFiles() if f.endswith("article.json")]
    assert sorted(r["a"] for r in df.collect()) == list(range(60))


def test_scan_filtered_case_insensitive_and_limit(spark, tmpdir_path):
    _write_corpus(tmpdir_path)
    assert scan_articles_filtered(spark, tmpdir_path, ".json").count() == 2
    assert scan_articles_filtered(spark, tmpdir_path, "", limit=1).count() == 1


def test_word2vec_text_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([("a", [0.5, -1.25]), ("b", [3.0, 0.1])], "term string, vector array<float>")
    path = os.path.join(tmpdir_path, "w2v")
    write_word2vec_text(df, path)
    back = {r["term"]: r["vector"] for r in scan_word_vectors(spark, path, fmt="word2vec").collect()}
    assert back["a"] == [0.5, -1.25] and len(back) == 2


def test_word2vec_one_dimension_spaces_and_numeric_terms(spark, tmpdir_path):
    for name, rows in {"one": [("a", [1.0]), ("2", [2.0]), ("3 1", [3.0])], "spaces": [("new york", [1.0, 2.0]), ("x", [0.0, 1.0])]}.items():
        path = os.path.join(tmpdir_path, name)
        write_word2vec_text(spark.createDataFrame(rows, "term string, vector array<float>"), path)
        assert sorted((r["term"], r["vector"]) for r in scan_word_vectors(spark, path, fmt="word2vec").collect()) == sorted(rows)


def test_snapshot_calls_the_client_once_per_missing_uri(spark, tmpdir_path):
    arts = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "article_key string")
    snap = spark.createDataFrame([("a",)], "article_key string")
    log = os.path.join(tmpdir_path, "calls")
    os.makedirs(log)

    def factory():
        def client(uris):
            for u in uris:
                with open(os.path.join(log, u), "a") as fo:
                    fo.write("x")
            return [[{"uri": u}] * 2 for u in uris]
        return client
    out = topic_snapshot_refresh(arts, snap, client_factory=factory, append_to=os.path.join(tmpdir_path, "snap"), partitions=1)
    assert out.count() == 2
    assert sorted((r["article_key"], r["n_topics"]) for r in out.collect()) == [("b", 2), ("c", 2)]
    assert spark.read.parquet(os.path.join(tmpdir_path, "snap")).count() == 2
    assert {u: open(os.path.join(log, u)).read() for u in os.listdir(log)} == {"b": "x", "c": "x"}


def test_streams_with_equal_folder_names_share_nothing(spark, tmpdir_path):
    for parent, headline in (("p1", "First"), ("p2", "Second")):
        src = os.path.join(tmpdir_path, parent, "in")
        os.makedirs(src)
        with open(os.path.join(src, "12345678"), "w") as fo:
            json.dump(_doc("/news/uk-12345678", headline, "Body."), fo)
        enrich_stream(spark, src, os.path.join(tmpdir_path, parent, "out")).awaitTermination(120)
    for parent in ("p1", "p2"):
        assert spark.read.json(os.path.join(tmpdir_path, parent, "out")).count() == 1


def test_streaming_enrichment(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    _write_corpus(src)
    out = os.path.join(tmpdir_path, "out")
    q = enrich_stream(spark, src, out, checkpoint=os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.json(out)
    assert got.count() == 3
    assert got.where(F.col("isBrexit")).count() == 3


def test_repeated_keys_give_one_document_each(spark, tmpdir_path):
    from inkwell.plans.features import enrich_corpus
    from tests.conftest import article_row, articles_df
    rows = [article_row(key="a", headline="One."), article_row(key="a", headline="Two!"), article_row(key="b", headline="Three.")]
    enrich_corpus(articles_df(spark, rows), f"{tmpdir_path}/out")
    found = spark.read.json(f"{tmpdir_path}/out").select("article_key", "promo.headlines.headline", "features.sentiment_label").collect()
    assert sorted(tuple(r)[:2] for r in found) == [("a", "One."), ("a", "Two!"), ("b", "Three.")]


def _files(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f)).read()
            for d, _, fs in os.walk(root) for f in fs if not f.endswith(".crc")}


def test_documents_keep_their_paths(spark, tmpdir_path):
    rows = {"a/x.json": "1", "b/x.json": "2", "x.json": "é\n3", "b/c d/+ü%20.json": None}
    df = spark.createDataFrame(list(rows.items()), "path string, content string")
    target = os.path.join(tmpdir_path, "out")
    write_documents(df, target)
    assert _files(target) == {k: v or "" for k, v in rows.items()}
    with pytest.raises(FileExistsError):
        write_documents(df, target)
    write_documents(df.limit(0), target, overwrite=True)
    assert _files(target) == {} and os.listdir(tmpdir_path) == ["out"]


@pytest.mark.parametrize("bad", [[("a", "1"), ("a", "1")], [("../a", "1")], [(None, "1")], [("/a", "1")], [("a//b", "1")]])
def test_a_failed_write_leaves_nothing(spark, tmpdir_path, bad):
    target = os.path.join(tmpdir_path, "out")
    write_documents(spark.createDataFrame([("kept", "old")], "path string, content string"), target)
    df = spark.createDataFrame([(f"f{i}", "x") for i in range(50)] + bad, "path string, content string")
    with pytest.raises(Exception, match="two documents|not a path"):
        write_documents(df, target, overwrite=True)
    assert _files(target) == {"kept": "old"} and os.listdir(tmpdir_path) == ["out"]


def test_enriched_files_mirror_the_input(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "in +é"), os.path.join(tmpdir_path, "out")
    os.makedirs(src)
    _write_corpus(src)
    os.makedirs(os.path.join(src, "other"))
    with open(os.path.join(src, "other", "12345678"), "w") as fo:      # a name that another folder has too
        json.dump(_doc("/news/uk-12345678", "Four", "Body."), fo)
    enrich_files(scan_articles(spark, src), src, out)
    got = {p: json.loads(t) for p, t in _files(out).items()}
    assert {p: d["promo"]["headlines"]["headline"] for p, d in got.items()} == {
        "12345678": "One", "sub/23456789.JSON": "Two", "34567890.json": "Three", "other/12345678": "Four"}
    assert all("sentiment_label" in d["features"] for d in got.values())


def test_snapshot_rerun_appends_nothing_twice(spark, tmpdir_path):
    arts = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "article_key string")
    stale = spark.createDataFrame([("a",)], "article_key string")
    path = os.path.join(tmpdir_path, "snap")

    def broken():
        def client(uris):
            raise RuntimeError("client is down")
        return client
    with pytest.raises(Exception, match="client is down"):
        topic_snapshot_refresh(arts, stale, client_factory=broken, append_to=path)
    for wanted in (2, 0):            # the second run starts from the same stale snapshot
        assert topic_snapshot_refresh(arts, stale, append_to=path).count() == wanted
    assert sorted(r["article_key"] for r in spark.read.parquet(path).collect()) == ["b", "c"]
    # killed halfway through its append: one file of two is there
    kept = [f for f in os.listdir(path) if f.endswith(".parquet")][0]
    half = os.path.join(tmpdir_path, "half")
    os.makedirs(half)
    os.link(os.path.join(path, kept), os.path.join(half, kept))
    topic_snapshot_refresh(arts, stale, append_to=half)
    assert sorted(r["article_key"] for r in spark.read.parquet(half).collect()) == ["b", "c"]
