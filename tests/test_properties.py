"""Property tests: Spark expressions against brute-force Python versions of
the behaviour we reproduce, on random inputs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.functions import fields as B
from inkwell.functions.predicates import joined_lower, keyword_match
from inkwell.functions.text import collapse_whitespace, split_on_period

ALPHABET = "ab c.\n\t  -_Ab"
SETTINGS = dict(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_keywords(segments, should, should_not):
    text = " ".join(s.lower() for s in segments)
    if any(text.find(s.lower()) >= 0 for s in should_not):
        return False
    return any(text.find(s.lower()) >= 0 for s in should)


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=1, max_size=4),
       st.lists(st.text(alphabet="abAB c", min_size=1, max_size=3), max_size=3),
       st.lists(st.text(alphabet="abAB c", min_size=1, max_size=3), max_size=2))
def test_keyword_match_matches_brute_force(spark, segments, should, should_not):
    df = spark.createDataFrame([(segments,)], "segs array<string>")
    got = df.select(keyword_match(joined_lower([F.col("segs")]), should, should_not).alias("v")).first()["v"]
    assert got == brute_keywords(segments, should, should_not)


@settings(**SETTINGS)
@given(st.text(alphabet=ALPHABET + "　 \x1c", max_size=30))
def test_collapse_whitespace_is_python_split_join(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(collapse_whitespace(F.col("t")).alias("v")).first()["v"] == " ".join(text.split())


@pytest.mark.parametrize("name,want", [
    ("thing_id", "thingId"), ("_thing_id", "_thingId"), ("THING_ID", "thingId"), ("a__b", "a_B"), ("_", "__"), ("", "_"),
    ("__a_b_", "__aB_"), ("one", "one"), ("camelCase_x", "camelcaseX")])
def test_camel_case_rule(name, want):
    assert B.underscore_to_camel(name) == want


@settings(**SETTINGS)
@given(st.text(alphabet="ab. ", max_size=20))
def test_period_split_is_str_split(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(split_on_period(F.col("t")).alias("v")).first()["v"] == text.split(".")
