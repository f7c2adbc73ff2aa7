"""A sentence splitter that learns abbreviations from the corpus.

A period ends a sentence unless it belongs to the word.  Which words it belongs
to is learned without labels (Kiss and Strunk, "Unsupervised Multilingual
Sentence Boundary Detection", 2006) from one aggregate over all texts: counts of
(word type, has a period, next type if it has).  From these few rows come

* abbreviations: types whose periods a log-likelihood ratio cannot put down to
  chance, weighted for short words, inner periods and few uses without one;
* sentence starters: types that follow sentence breaks more than by chance;
* collocations: pairs over an abbreviation's period that belong together.

No type or pair is left out for being rare.  Breaks are a projection of each
row: after ``!`` and ``?``, after a period that is not an abbreviation's (nor an
initial's), and after an abbreviation before a capitalised sentence starter that
is no collocation with it; not after ``...`` before a small letter.  Sets of up to
``LITERALS`` entries are dictionaries of the plan (``SentenceModel``).  Larger ones
stay tables (``SentenceTables``): the pairs over periods of each row are joined with
them, and a row gets the pairs that do not end a sentence, a list as long as a
text has different ones.

Sentences are their words joined by one space.  A null text gives null, a blank
one no sentence; an empty corpus teaches nothing, and every period breaks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import SENTENCE_BREAK, WHITESPACE, bind, literal_lookup
from inkwell.session import materialize_table

#: Entries of a set that the driver collects; with more, the sets stay tables.
LITERALS = 100_000
#: Bounds of the paper: weighted score of an abbreviation, likelihood ratios of
#: a sentence starter and of a collocation.
ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88

OPENING, CLOSING = "\"'([", "\"')]"


def tokens(text: Column) -> Column:
    words = F.split(F.regexp_replace(text, WHITESPACE + "+", " "), " ")
    return F.filter(words, lambda w: w != "")


def _core(word: Column) -> Column:
    return F.rtrim(word, F.lit(CLOSING))


def _bare(core: Column) -> Column:
    return F.ltrim(core, F.lit(OPENING))


def _type(bare: Column) -> Column:
    return F.lower(F.when(bare.endswith("."), F.substr(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare))


def _capital(bare: Column) -> Column:
    return bare.rlike(r"^\p{Lu}")


def _words(text: Column, *more: Callable[[Column], Column]) -> Column:
    """Array of (type, period, next) and what ``more`` takes of the next bare
    word; ``next`` and these only behind a period."""
    def described(word: Column) -> Column:
        return bind(_core(word), lambda core: F.struct(
            _type(_bare(core)).alias("type"), core.endswith(".").alias("period"), *[f(_bare(core)).alias(f"m{k}") for k, f in enumerate(more)]))

    def rows(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.struct(w["type"].alias("type"), w["period"].alias("period"), *[
            F.when(w["period"], F.get(words, i + 1)[of]).alias(name) for of, name in (("type", "next"), *((f"m{k}", f"m{k}") for k in range(len(more))))]))

    return bind(F.transform(tokens(text), described), rows)


def type_counts(df: DataFrame, text: str) -> DataFrame:
    """(type, period, next, n) over all texts; ``next`` only behind a period."""
    return df.select(F.explode(_words(F.col(text))).alias("w")).select("w.*").groupBy("type", "period", "next").agg(F.count("*").alias("n"))


def _chance(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))


def _log_likelihood(hits: Column, tries: Column, p: Column) -> Column:
    return hits * F.log(_chance(p)) + (tries - hits) * F.log1p(-_chance(p))


def period_ratio(with_period: Column, total: Column, share: Column) -> Column:
    """-2 log of: the type gets periods like any word, over: nearly always."""
    return -2 * (_log_likelihood(with_period, total, share) - _log_likelihood(with_period, total, F.lit(0.99)))


def pair_ratio(first: Column, second: Column, both: Column, n: Column) -> Column:
    """Dunning's ratio for ``second`` behind ``first``."""
    p, p1, p2 = second / n, both / first, (second - both) / F.greatest(n - first, F.lit(1))
    return -2 * (_log_likelihood(both, first, p) + _log_likelihood(second - both, n - first, p)
                 - _log_likelihood(both, first, p1) - _log_likelihood(second - both, n - first, p2))


def _is_initial(kind: Column) -> Column:
    return kind.rlike(r"^\p{L}$")


def _splitter(ends: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    """``ends``: does a period behind this type end a sentence before this bare word?"""
    def period_ends(core: Column, following: Column) -> Column:
        def judged(bare: Column) -> Column:
            dots = core.endswith("...") & bare.rlike(r"^\p{Ll}")
            return F.when(dots, False).otherwise(bind(_type(_bare(core)), lambda kind: ends(kind, bare)))
        return bind(_bare(_core(following)), judged)

    def breaks(words: Column, word: Column, i: Column) -> Column:
        following = F.get(words, i + 1)
        return F.when(following.isNull(), False).otherwise(bind(_core(word), lambda core: F.when(
            core.endswith("!") | core.endswith("?"), True).when(core.endswith("."), period_ends(core, following)).otherwise(False)))

    def split(text: Column) -> Column:
        def marked(words: Column) -> Column:
            return F.transform(words, lambda w, i: F.concat(w, F.when(breaks(words, w, i), F.lit(SENTENCE_BREAK)).otherwise(F.lit(" "))))

        joined = F.array_join(bind(tokens(text), marked), "")
        return F.filter(F.transform(F.split(joined, SENTENCE_BREAK), lambda s: F.trim(s)), lambda s: s != "")

    return split


@dataclass(frozen=True)
class SentenceModel:
    abbreviations: frozenset[str]
    starters: frozenset[str]
    collocations: frozenset[tuple[str, str]]

    def splitter(self) -> Callable[[Column], Column]:
        """Column -> array of sentences, for ``sentences`` and ``article_sentiment``."""
        known = [literal_lookup(dict.fromkeys(items, 1), "int") for items in (
            self.abbreviations, self.starters, {" ".join(pair) for pair in self.collocations})]
        abbreviation, starter, collocation = ((lambda c, look=look: look(c).isNotNull()) for look in known)

        def ends(kind: Column, bare: Column) -> Column:
            after = _type(bare)
            starts = _capital(bare) & starter(after) & ~collocation(F.concat_ws(" ", kind, after))
            return F.when(abbreviation(kind) | _is_initial(kind), starts).otherwise(True)

        return _splitter(ends)

    def over(self, df: DataFrame, text: str) -> tuple[DataFrame, Callable[[Column], Column]]:
        """``df`` and a splitter for its ``text``."""
        return df, self.splitter()


#: Column of a row's pairs that do not end a sentence.
HELD = "_held_together"


def _pair(kind: Column, after: Column, capital: Column) -> Column:
    return F.concat_ws(" ", kind, after, capital.cast("string"))


@dataclass(frozen=True)
class SentenceTables:
    """The same sets as tables ``type``, ``next`` and ``type, next``."""
    abbreviations: DataFrame
    starters: DataFrame
    collocations: DataFrame

    def over(self, df: DataFrame, text: str) -> tuple[DataFrame, Callable[[Column], Column]]:
        """``df`` with the column ``HELD``, and a splitter for its ``text``.  The
        rows are written and numbered, so keys may repeat."""
        rows = materialize_table(df.withColumn("_row", F.monotonically_increasing_id()), "sentence-texts")
        asked = F.array_distinct(F.filter(_words(F.col(text), _capital), lambda w: w["next"].isNotNull()))
        pairs = rows.select("_row", F.explode(asked).alias("w")).select("_row", "w.type", "w.next", F.col("w.m0").alias("capital"))
        own = _flagged(pairs, self.abbreviations, ["type"], "abbreviation").where(F.col("abbreviation") | _is_initial(F.col("type")))
        known = _flagged(_flagged(own, self.starters, ["next"], "starter"), self.collocations, ["type", "next"], "together")
        held = known.where(~(F.col("capital") & F.col("starter") & ~F.col("together"))) \
            .groupBy("_row").agg(F.collect_list(_pair(F.col("type"), F.col("next"), F.col("capital"))).alias(HELD))

        def ends(kind: Column, bare: Column) -> Column:
            return ~F.coalesce(F.array_contains(F.col(HELD), _pair(kind, _type(bare), _capital(bare))), F.lit(False))

        return rows.join(held, "_row", "left").drop("_row"), _splitter(ends)


def _flagged(df: DataFrame, entries: DataFrame, on: list[str], name: str) -> DataFrame:
    """``df`` with the boolean ``name``: is the row's key an entry?"""
    return df.join(entries.withColumn("_known", F.lit(True)), on, "left") \
        .withColumn(name, F.col("_known").isNotNull()).drop("_known")


def train_sentences(df: DataFrame, text: str, max_types: int | None = None) -> SentenceModel | SentenceTables:
    """Learn from all texts of ``df``; the one pass over them is ``type_counts``.
    With ``max_types`` a type or pair needs one in so many of all words with a
    period."""
    counts = materialize_table(type_counts(df, text), "sentence-types")
    types = counts.groupBy("type").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("period"), F.col("n")).otherwise(0)).alias("dotted"))
    n, dotted = types.agg(F.sum("total"), F.sum("dotted")).first()
    if not dotted:
        return SentenceModel(frozenset(), frozenset(), frozenset())
    at_least = dotted / max_types if max_types else 1
    plain = F.length(F.replace("type", F.lit("."), F.lit("")))
    score = (period_ratio(F.col("dotted"), F.col("total"), F.lit(dotted / n)) * F.exp(-plain)
             * (F.length("type") - plain + 1) * F.pow(plain.cast("double"), -(F.col("total") - F.col("dotted")).cast("double")))
    abbreviations = types.filter(F.col("type").rlike(r"\p{L}") & (F.col("dotted") >= at_least)).filter(score >= ABBREVIATION).select("type")
    abbreviations = materialize_table(abbreviations, "abbreviations")

    pairs = _flagged(counts.filter("period AND next IS NOT NULL"), abbreviations, ["type"], "known") \
        .withColumn("own", F.col("known") | _is_initial(F.col("type")))
    follower = types.select(F.col("type").alias("next"), F.col("total").alias("next_total"))
    breaks = pairs.filter("NOT own").agg(F.sum("n")).first()[0] or 0
    attracted = F.col("both") * n > F.col("first") * F.col("next_total")
    after_break = (pairs.filter("NOT own").groupBy("next").agg(F.sum("n").alias("both")).join(follower, "next")
                   .withColumn("first", F.lit(breaks)).filter(attracted & F.col("next").rlike(r"\p{L}") & (F.col("both") >= at_least)))
    starters = after_break.filter(pair_ratio(F.col("first"), F.col("next_total"), F.col("both"), F.lit(n)) > STARTER).select("next")
    together = (pairs.filter("own").select("type", "next", F.col("n").alias("both")).filter((F.col("both") > 1) & (F.col("both") >= at_least))
                .join(follower, "next").join(types.select("type", F.col("dotted").alias("first")), "type").filter(attracted))
    collocations = together.filter(pair_ratio(F.col("first"), F.col("next_total"), F.col("both"), F.lit(n)) > COLLOCATION).select("type", "next")
    tables = [abbreviations, materialize_table(starters, "starters"), materialize_table(collocations, "collocations")]
    if max(t.count() for t in tables) > LITERALS:
        return SentenceTables(*tables)
    known = [t.collect() for t in tables]
    return SentenceModel(*(frozenset(r[0] for r in rows) for rows in known[:2]), frozenset(map(tuple, known[2])))
