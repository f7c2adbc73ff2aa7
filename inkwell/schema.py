"""Declared schemas (no inference on the hot path).

F1 is pruned to the fields the features read; reading raw article JSON with
this schema lets the JSON reader skip everything else."""

from pyspark.sql import types as T

S, L, B = T.StringType(), T.LongType(), T.BooleanType()

TAG = T.StructType([
    T.StructField("thingId", S),
    T.StructField("thingLabel", S),
    T.StructField("thingUri", S),
    T.StructField("thingType", T.ArrayType(S)),
])

BLOCK = T.StructType([
    T.StructField("type", S),
    T.StructField("text", S),
    T.StructField("markupType", S),
])

# article document
ARTICLE = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("locators", T.StructType([T.StructField("assetUri", S)])),
        T.StructField("lastUpdated", L),
        T.StructField("firstPublished", L),
        T.StructField("lastPublished", L),
        T.StructField("timestamp", L),
        T.StructField("adCampaignKeyword", S),
        T.StructField("isOppm", B),
        T.StructField("options", T.StructType([
            T.StructField("hasContentWarning", B),
            T.StructField("isBreakingNews", B),
        ])),
        T.StructField("tags", T.StructType([
            T.StructField("about", T.ArrayType(TAG)),
        ])),
    ])),
    T.StructField("promo", T.StructType([
        T.StructField("headlines", T.StructType([
            T.StructField("headline", S),
            T.StructField("shortHeadline", S),
        ])),
        T.StructField("summary", S),
    ])),
    T.StructField("content", T.StructType([
        T.StructField("blocks", T.ArrayType(BLOCK)),
    ])),
])

# topic mentions, one row per article x topic
MENTIONS = T.StructType([
    T.StructField("article_key", S),
    T.StructField("source", S),
    T.StructField("uri", S),
    T.StructField("label", S),
    T.StructField("surface_form", S),
    T.StructField("types", T.ArrayType(S)),
    T.StructField("count", T.IntegerType()),
    T.StructField("same_as", T.ArrayType(S)),
])

# knowledge-base facts
KB_FACTS = T.StructType([
    T.StructField("subject", S),
    T.StructField("predicate", S),
    T.StructField("value", S),
])

# dictionaries
NAME_GENDER = T.StructType([
    T.StructField("first_name", S),
    T.StructField("gender", S),
    T.StructField("provider", S),
])
LEXICON = T.StructType([
    T.StructField("term", S),
    T.StructField("valence", T.DoubleType()),
])

# training rows
SARCASM_ROW = T.StructType([
    T.StructField("headline", S),
    T.StructField("is_sarcastic", T.IntegerType()),
])
REVIEW_ROW = T.StructType([
    T.StructField("review", S),
    T.StructField("sentiment", S),
])

# word vectors
WORD_VECTORS = T.StructType([
    T.StructField("term", S),
    T.StructField("count", L),
    T.StructField("vector", T.ArrayType(T.FloatType())),
])
