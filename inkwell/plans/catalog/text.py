"""Sentences, lexicon sentiment, vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import fields as B
from inkwell.operators import sentiment as SO
from inkwell.operators.sentence_model import ABBREVIATION, COLLOCATION, STARTER, train_sentences
from inkwell.operators.vocab import top_vocab
from inkwell.plans import oracles as O
from inkwell.plans.catalog import register
from inkwell.plans.oracle_sentiment import label_sql, split_sql, vader_ctes
from inkwell.plans.standins import load_articles
from inkwell.session import read_table


def _combined(spark, sf):
    return load_articles(spark, sf).select("doc_id", B.combined_text().alias("text"))


SENTS_CTE = (f"sents_ AS (SELECT doc_id, CAST(generate_subscripts(sl, 1) - 1 AS INTEGER) AS sent_idx, unnest(sl) AS stext "
             f"FROM (SELECT doc_id, {split_sql(O.COMBINED)} AS sl FROM articles))")


@register("sentences", O.with_articles("SELECT doc_id, sent_idx, stext AS sentence FROM sents_", SENTS_CTE))
def sentences_q(spark, sf):
    return SO.sentences(_combined(spark, sf), "text", ["doc_id"])


@register("lexicon_sentiment", O.with_articles(
    "SELECT doc_id, sent_idx, compound FROM vader_out", SENTS_CTE + vader_ctes("sents_", ["doc_id", "sent_idx"])))
def lexicon_sentiment_q(spark, sf):
    return SO.lexicon_sentiment(_combined(spark, sf), "text", ["doc_id"]).select("doc_id", "sent_idx", "compound")


# A dictionary of words, word sequences and raw tokens that the documents hold.
PHRASES = {"of the": 1.4, "the and": 0.8, "and the of": -2.2, "in the": -1.1, "the the": 2.6, "la un": 1.7,
           "de le la": -1.9, "des": -0.6, "der die": 1.2, "der die und": -1.6, "is": 0.4, "and,": -0.7, "the.": 1.1}


@register("phrase_sentiment", f"""WITH sents_ AS (SELECT doc_id, CAST(generate_subscripts(sl, 1) - 1 AS INTEGER)
  AS sent_idx, unnest(sl) AS stext FROM (SELECT doc_id, {split_sql('text')} AS sl FROM documents))"""
          + vader_ctes("sents_", ["doc_id", "sent_idx"], PHRASES) + " SELECT doc_id, sent_idx, compound FROM vader_out")
def phrase_sentiment_q(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return SO.lexicon_sentiment(docs, "text", ["doc_id"], PHRASES).select("doc_id", "sent_idx", "compound")


def _ll(hits: str, tries: str, p: str) -> str:
    chance = f"least(greatest({p}, 1e-12), 1 - 1e-12)"
    return f"(({hits}) * ln({chance}) + (({tries}) - ({hits})) * ln(1 - {chance}))"


def _pair_ll(first: str, second: str, both: str) -> str:
    rest, others = f"({second} - {both})", f"(n - {first})"
    p, p1, p2 = f"{second}::double / n", f"{both}::double / {first}", f"{rest}::double / greatest({others}, 1)"
    return (f"-2 * ({_ll(both, first, p)} + {_ll(rest, others, p)} - {_ll(both, first, p1)} - {_ll(rest, others, p2)})")


_LEARNED = f"""
words_ AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (
  SELECT doc_id, list_filter(string_split(regexp_replace({O.COMBINED}, '{O.WS}+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM articles)),
cores_ AS (SELECT *, regexp_replace(w, '["'')\\]]+$', '') AS core FROM words_),
bares_ AS (SELECT *, regexp_replace(core, '^["''(\\[]+', '') AS bare FROM cores_),
parts_ AS (SELECT doc_id, i, w, lower(regexp_replace(bare, '\\.$', '')) AS type, ends_with(core, '.') AS period,
    regexp_matches(core, '[!?]$') AS mark, regexp_matches(core, '(\\.\\.\\.|…)$') AS dots,
    regexp_matches(bare, '^\\p{{Lu}}') AS up, regexp_matches(bare, '^\\p{{Ll}}') AS low FROM bares_),
next_ AS (SELECT *, lead(type) OVER p AS next, lead(up) OVER p AS next_up, lead(low) OVER p AS next_low FROM parts_
          WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
types_ AS (SELECT type, count(*) AS total, count(*) FILTER (period) AS dotted FROM parts_ GROUP BY type),
sums_ AS (SELECT sum(total)::double AS n, sum(dotted)::double AS nb FROM types_),
scored_ AS (SELECT types_.*, sums_.*, length(replace(type, '.', '')) AS plain,
    -2 * ({_ll('dotted', 'total', 'nb / n')} - {_ll('dotted', 'total', '0.99::double')}) AS ratio FROM types_, sums_),
abbr_ AS (SELECT type FROM scored_ WHERE regexp_matches(type, '\\p{{L}}') AND dotted > 0
    AND ratio * exp(-plain) * (length(type) - plain + 1) * pow(plain::double, -(total - dotted)::double) >= {ABBREVIATION}),
own_ AS (SELECT *, type IN (SELECT type FROM abbr_) OR regexp_matches(type, '^\\p{{L}}$') AS own FROM next_ WHERE period),
breaks_ AS (SELECT count(*)::double AS first FROM own_ WHERE NOT own AND next IS NOT NULL),
starters_ AS (SELECT next FROM (SELECT next, count(*)::double AS pair_n FROM own_ WHERE NOT own AND next IS NOT NULL GROUP BY next) s
    JOIN types_ t ON t.type = s.next, breaks_, sums_
    WHERE pair_n * n > first * total AND regexp_matches(next, '\\p{{L}}')
      AND {_pair_ll('first', 'total', 'pair_n')} > {STARTER}),
together_ AS (SELECT c.type, c.next FROM (SELECT type, next, count(*)::double AS pair_n FROM own_ WHERE own AND next IS NOT NULL GROUP BY ALL) c
    JOIN types_ t ON t.type = c.next JOIN (SELECT type, dotted::double AS first FROM types_) f ON f.type = c.type, sums_
    WHERE pair_n > 1 AND pair_n * n > first * t.total AND {_pair_ll('first', 't.total', 'pair_n')} > {COLLOCATION}),
ends_ AS (SELECT *, CASE WHEN next IS NULL THEN false WHEN mark THEN true WHEN NOT period THEN false WHEN dots AND next_low THEN false
    WHEN type IN (SELECT type FROM abbr_) OR regexp_matches(type, '^\\p{{L}}$')
    THEN next_up AND next IN (SELECT next FROM starters_) AND (type, next) NOT IN (SELECT (type, next) FROM together_) ELSE true END AS ends FROM next_),
learned_ AS (SELECT *, coalesce(sum(ends::int) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ends_)"""


@register("sentences_learned", O.with_articles(
    "SELECT doc_id, CAST(s AS INTEGER) AS sent_idx, string_agg(w, ' ' ORDER BY i) AS sentence FROM learned_ GROUP BY doc_id, s", _LEARNED))
def sentences_learned_q(spark, sf):
    texts = _combined(spark, sf)
    texts, splitter = train_sentences(texts, "text").over(texts, "text")
    return SO.sentences(texts, "text", ["doc_id"], splitter)


TURNS = ("WITH turns_ AS (SELECT conv_id, turn, text AS stext FROM conversations)"
         + vader_ctes("turns_", ["conv_id", "turn"]))


@register("sentiment_mean", TURNS + " SELECT conv_id, round(avg(compound), 6) AS sentiment_score, "
          "count(*) AS n_segments FROM vader_out GROUP BY conv_id")
def sentiment_mean_q(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return SO.sentiment_mean(conv, "text", ["conv_id"]).withColumn(
        "sentiment_score", F.round("sentiment_score", 6))


@register("sentiment_label", TURNS + f" SELECT conv_id, turn, compound AS sentiment_score, "
          f"{label_sql('compound')} AS sentiment_label FROM vader_out")
def sentiment_label_q(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return SO.article_sentiment(conv, "text", ["conv_id", "turn"], convert_to_sents=False) \
        .select("conv_id", "turn", "sentiment_score", "sentiment_label")


@register("article_sentiment", O.with_articles(
    f"SELECT a.doc_id, CAST(count(v.compound) AS INTEGER) AS n_sentences, round(avg(v.compound), 6) AS sentiment_score, "
    f"{label_sql('avg(v.compound)')} AS sentiment_label "
    f"FROM articles a LEFT JOIN vader_out v ON a.doc_id = v.doc_id GROUP BY a.doc_id",
    SENTS_CTE + vader_ctes("sents_", ["doc_id", "sent_idx"])))
def article_sentiment_q(spark, sf):
    out = SO.article_sentiment(_combined(spark, sf), "text", ["doc_id"])
    return out.withColumn("sentiment_score", F.round("sentiment_score", 6))


TOP_K = 100


@register("top_vocab", f"""
SELECT term, count(*) AS n FROM (
  SELECT unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS term FROM documents)
WHERE term <> '' GROUP BY term ORDER BY n DESC, term LIMIT {TOP_K}""")
def top_vocab_q(spark, sf):
    return top_vocab(read_table(spark, sf, "documents"), "text", TOP_K)
