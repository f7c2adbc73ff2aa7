"""Work that a query must do once, or only where it is needed."""

from pyspark.sql import functions as F

from inkwell.functions import sentiment as S
from inkwell.operators import evaluation as G
from inkwell.operators import sentence_model as M


def test_exact_profile_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(x):
        seen.add(1)
        return float(x)
    udf = F.udf(score, "double").asNondeterministic()
    df = spark.range(40, numPartitions=2).select(udf("id").alias("v"), F.lit("a").alias("k"))
    got = {r["stat"]: r["value"] for r in G.profile(df, "v", "k", approx=False).collect()}
    assert got["count"] == 40 and got["50%"] == 19.5 and got["count_a"] == 40
    assert seen.value == 40


def test_idioms_are_searched_only_where_one_begins(spark):
    lex = S.lexicon_map({"kiss of death": -2.0, "bad ass": 1.5, "kiss": 1.0})
    texts = ["a kiss of death", "kiss and of death", "bad ass thing", "the bad thing", "", None, "ass bad", "kiss of life"]
    words = F.transform(S.tokens(F.col("t")), lex.word)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(lex.starts(words, lex.entries(words))).collect()]
    assert got == [True, False, True, False, False, None, False, False]
    # a framing character inside a word still disappears where a first word is
    assert spark.range(1).select(S.sentence_compound(F.lit("KI﷐SS of death and kiss"), lex) < 0).first()[0]


def test_words_are_described_without_a_pattern_each(spark):
    df = spark.createDataFrame([("He met \"Dr.\" Who (etc.). It rained... so what?!",)], "t string")
    plan = M.type_counts(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and plan.count("regexp_replace") == 1
    got = {(r["type"], r["period"], r["next"]) for r in M.type_counts(df, "t").collect()}
    assert {("dr", True, "who"), ("etc.)", True, "it")} & got and ("rained..", True, "so") in got and ("what?!", False, None) in got


def test_text_vectors_in_many_blocks(spark):
    from collections import defaultdict

    from inkwell.operators.embeddings import text_vectors
    rows = [(1, "The cat, the dog"), (1, "cat"), (None, "dog unknown"), (2, "unknown"), (3, None), (4, ""), (5, "dog " * 50 + "cat")]
    table = [("the", 2, [1.0, 0.0]), ("cat", 2, [0.0, 2.0]), ("dog", 1, [4.0, 4.0]), ("dog", 1, [0.0, 2.0])]
    want = defaultdict(list)
    for key, text in rows:
        for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            want[key] += [v for t, _, v in table if t == w]
    vectors = spark.createDataFrame(table, "term string, count long, vector array<float>")
    got = text_vectors(spark.createDataFrame(rows, "k int, t string"), "k", "t", vectors, block_chars=4).collect()
    assert {r["k"]: [round(x, 9) for x in r["vector"]] for r in got} == {
        k: [round(sum(v[d] for v in vs) / len(vs), 9) for d in (0, 1)] for k, vs in want.items() if vs}


def test_keyword_numbers_in_bounded_batches(spark):
    from array import array

    from inkwell.operators import keyword_automaton as K
    assert K._lists(array("i", [3, 5, 5]), [0, 2, 2, 2, 3], [False, True, False, False]).to_pylist() == [[3, 5], None, [], [5]]
    assert K._lists(array("i"), [0, 0], [True]).to_pylist() == [None]
    words = [f"w{i:03d}" for i in range(300)]
    df = spark.createDataFrame([(i, None if i % 7 == 0 else " ".join(words[: i % 5 * 70])) for i in range(9000)], "i int, t string").coalesce(1)
    got = df.select("i", K.keyword_numbers(F.col("t"), words).alias("n")).collect()
    assert len(got) == 9000 and all(r["n"] == (None if r["i"] % 7 == 0 else list(range(r["i"] % 5 * 70))) for r in got)


def test_scan_of_many_files_groups_them(spark, tmp_path):
    from pyspark.sql import types as T

    from inkwell.sources.articles import TASKS, scan_articles
    n = TASKS + 40
    for i in range(n):
        (tmp_path / f"{i % 3}").mkdir(exist_ok=True)
        (tmp_path / f"{i % 3}" / f"{i}.json").write_text(f'{{"doc_id": {i}}}')
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        df = scan_articles(spark, str(tmp_path), T.StructType([T.StructField("doc_id", T.LongType())]))
        assert df.rdd.getNumPartitions() == TASKS
        assert sorted((r["doc_id"], r["file_name"]) for r in df.collect()) == sorted((i, f"{i}.json") for i in range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
