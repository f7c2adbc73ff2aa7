import random
from math import ceil, floor

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import mixing
from inkwell.llm.queries import OTHER_WEIGHT, TARGET_WEIGHTS, op7
from tests.llm.helpers import documents, save


def slow_pattern(shares):
    """Earliest deadline first, slot by slot."""
    w, done, order = sum(shares), [0] * len(shares), []
    for t in range(w):
        due = [(ceil((d + 1) * w / s), i) for i, (d, s) in enumerate(zip(done, shares)) if d < s and floor(d * w / s) <= t]
        pick = min(due)[1]
        done[pick] += 1
        order.append(pick)
    return order


@pytest.mark.parametrize("shares", [[1], [3, 0, 1], [30, 10, 10, 10, 8, 8, 6, 6, 4, 4, 4], [1] * 9, [7, 5, 3, 2, 1, 1], [97, 1, 2]])
def test_pattern_is_edf_and_deviates_by_less_than_a_block(spark, shares):
    df = spark.createDataFrame([(shares,)], "shares array<int>")
    got = df.select(mixing.pattern(F.col("shares"))).first()[0]
    assert got == slow_pattern(shares)
    for t in range(1, len(got) + 1):
        for i, s in enumerate(shares):
            assert abs(got[:t].count(i) - t * s / sum(shares)) < 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(1, 30)), min_size=1, max_size=8))
def test_phases_use_every_block_once(streams):
    blocks, weights = [b for b, _ in streams], [w for _, w in streams]
    used = [0] * len(blocks)
    for shares, periods in mixing.phases(blocks, weights):
        used = [u + periods * s for u, s in zip(used, shares)]
        assert all(s <= w for s, w in zip(shares, weights))
    assert used == blocks


def skewed(n=900):
    rnd = random.Random(9)
    sources = ["src0"] * 12 + ["src1", "src2", "src3", "src9", "srcX", None]
    return [(i, f"t{i}", None, rnd.choice(sources)) for i in range(n)]


def test_every_document_has_one_place_in_its_window(spark, tmp_path):
    df = documents(spark, skewed(), stream="a", block="b", slot="c", bucket="d", hash="e", phases="f")
    rows = op7(spark, save(spark, tmp_path, documents=df)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(900))
    slots = {}
    for r in rows:
        assert r["release"] <= r["slot"] < r["deadline"]
        slots.setdefault(r["slot"], []).append((r["stream"], r["block"], r["place"]))
    assert sorted(slots) == list(range(len(slots)))
    for members in slots.values():
        assert len({m[:2] for m in members}) == 1 and sorted(m[2] for m in members) == list(range(len(members)))
    order = [slots[t][0][0] for t in range(len(slots))]
    live = [s for s in order if s == "src1"]
    last = max(t for t, s in enumerate(order) if s == "src1")
    assert len(live) == ceil(sum(r["stream"] == "src1" for r in rows) / mixing.BLOCK_DOCS) and last < len(order) - 1


def test_small_weights_hold_from_the_first_slot_on(spark):
    df = documents(spark, [(i, "x", None, "a" if i % 3 else "b") for i in range(600)])
    rows = mixing.mix(df, {"a": 3, "b": 2}, 1, block_docs=4).collect()
    order = [s for _, s in sorted({(r["slot"], r["stream"]) for r in rows})]
    for t in range(1, 100):
        assert abs(order[:t].count("a") - t * 3 / 5) < 1


def test_sources_without_a_weight_have_windows_of_their_own(spark):
    names = [f"new{i}" for i in range(9)]
    docs = [(i, "x", None, "big" if i % 3 == 0 else names[i % 9] if i % 7 else None) for i in range(1500)]
    rows = mixing.mix(documents(spark, docs), {"big": 5, "absent": 50}, 2, block_docs=2).collect()
    order = [s for _, s in sorted({(r["slot"], r["stream"]) for r in rows})]
    streams = set(order)
    assert streams == {"big", mixing.OTHER} | {n for _, _, _, n in docs if n}
    assert all(r["stream"] == (r["source"] or mixing.OTHER) for r in rows)
    weights = {s: 5 if s == "big" else 2 for s in streams}
    first_end = min(t for s in streams for t in [max(i for i, o in enumerate(order) if o == s)])
    for t in range(1, first_end - sum(weights.values())):
        for s, w in weights.items():
            assert abs(order[:t].count(s) - t * w / sum(weights.values())) < 1


def test_a_source_named_as_the_stream_of_rows_without_one(spark):
    rows = mixing.mix(documents(spark, [(1, "x", None, "other"), (2, "x", None, None), (3, "x", None, "a")]), {"a": 1}, 1).collect()
    assert {(r["doc_id"], r["stream"]) for r in rows} == {(1, "other"), (2, "other"), (3, "a")}


def test_query_against_sql(spark, tmp_path):
    sf = save(spark, tmp_path, documents=documents(spark, skewed(700)))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet/*.parquet')")
    want = con.execute(mixing.oracle(TARGET_WEIGHTS, OTHER_WEIGHT)).fetchall()
    got = op7(spark, sf)
    assert [c[0] for c in con.description] == got.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_mixed_keeps_all_rows_and_columns_in_slot_order(spark, tmp_path):
    df = documents(spark, [*skewed(300), (None, None, None, None), (7, "again", None, "src0"), (7, "again", None, "src0")],
                   row="r", slot="s", place="p")
    got = mixing.mixed(df, TARGET_WEIGHTS, OTHER_WEIGHT, block_docs=4)
    assert got.schema == df.schema
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    # partition by partition, the rows are in the order of their slots
    want = [r["doc_id"] for r in mixing.mix(df, TARGET_WEIGHTS, OTHER_WEIGHT, block_docs=4).orderBy("slot", "place").collect()]
    assert [r["doc_id"] for r in got.collect()] == want
    assert mixing.mixed(df.limit(0), TARGET_WEIGHTS, OTHER_WEIGHT).count() == 0
    assert op7(spark, save(spark, tmp_path, documents=df.limit(0))).count() == 0
