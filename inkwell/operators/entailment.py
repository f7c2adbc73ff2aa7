"""Entailment labelling (E10, E11) with an injected scorer.

For each topic (a bounded literal list) the hypothesis ``discusses a or b or
c`` is scored against the whole text.  A Column scorer sees the text as one
premise, whatever its length.  A model with an input limit sees windows of
``max_chars`` characters, each of which holds the first ``OVERLAP`` characters of the
next, so a term of up to that length is whole in one of them; the article's
probability is then that of its best window.  A scorer maps (premise, hypothesis, terms) Columns to the three
logits ``[contradiction, neutral, entailment]``; the probability is the
softmax over contradiction and entailment, ``1 / (1 + exp(l0 - l2))``.

The default scorer is a deterministic stand-in (no model weights ship
here): with ``h`` of the ``n`` topic terms found in the lowercased premise,
``l0 = 0`` and ``l2 = ln((h + 0.5) / (n - h + 0.5))``, i.e. probability
``(h + 0.5) / (n + 1)``.  A pretrained model plugs in through
``pandas_scorer``: an iterator pandas UDF that loads it once per task and
takes all windows of a row at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.config import ENTAILMENT_MAX_CHARS, ENTAILMENT_THRESHOLD, ENTAILMENT_TOPICS
from inkwell.functions.text import bind
from inkwell.session import ship_package

Scorer = Callable[[Column, Column, Sequence[str]], Column]

#: Characters that a window shares with the next one.
OVERLAP = 128


def hypothesis(terms: Sequence[str]) -> str:
    return "discusses " + " or ".join(terms)


def term_share_scorer(premise: Column, hyp: Column, terms: Sequence[str]) -> Column:
    """Default stand-in scorer -> array(l0, l1, l2)."""
    n = len(terms)
    # lowered and counted once, not once per term
    hits = bind(F.lower(premise), lambda low: sum(
        (F.when(low.contains(t.lower()), 1).otherwise(0) for t in terms), F.lit(0)))
    l2 = bind(hits, lambda h: F.log((h + 0.5) / (F.lit(n) - h + 0.5)))
    return F.array(F.lit(0.0), F.lit(0.0), l2)


def pandas_scorer(model_factory: Callable[[], Callable[[list[str], list[str]], np.ndarray]]) -> Scorer:
    """Wrap a batch model ``(premises, hypotheses) -> (n, 3) logits`` as a
    scorer of windows: the model is built once per task and sees the windows
    of an Arrow batch's rows in one call.  A row without windows gives null and
    reaches no model, also inside a ``CASE WHEN``."""

    @F.pandas_udf(T.DoubleType())
    def _score(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = model_factory()
        for given, hyp in it:
            rows = [None if w is None else windows(w) for w in given]
            counts = np.array([0 if w is None else len(w) for w in rows])
            best = np.full(len(rows), np.nan)
            if counts.any():
                owner = np.repeat(np.arange(len(rows)), counts)
                logits = np.asarray(model([x for w in rows if w is not None for x in w], hyp.iloc[owner].tolist()), float)
                best = np.where(counts > 0, 0.0, np.nan)
                np.maximum.at(best, owner, 1.0 / (1.0 + np.exp(logits[:, 0] - logits[:, 2])))
            yield pd.Series(best).astype(object).where(counts > 0, None)

    udf = _score.asNondeterministic()

    def scorer(premises: Column, hyp: Column, terms: Sequence[str]) -> Column:
        from pyspark.sql import SparkSession
        active = SparkSession.getActiveSession()
        if active is not None:
            ship_package(active)
        return udf(premises, hyp)

    scorer.takes_windows = True
    return scorer


def pieces(text: Column, max_chars: int) -> Column:
    """Consecutive pieces of a text, ``OVERLAP`` characters short of a window;
    none for an empty text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{max_chars - min(OVERLAP, max_chars // 2)}}}"), F.lit(0))


def windows(cut: Sequence[str]) -> list[str]:
    """Each piece with the first ``OVERLAP`` characters of the next one.  A last
    piece that is in the window before whole is no window of its own."""
    joined = [piece + after[:OVERLAP] for piece, after in zip(cut, [*cut[1:], ""])]
    return joined[:-1] if len(joined) > 1 and len(joined[-1]) <= OVERLAP else joined


def premises(text: Column, scorer: Scorer, max_chars: int = ENTAILMENT_MAX_CHARS, skip_empty: bool = True) -> Column:
    """What ``best_probability`` needs of a text, as a column of its own: the
    text, or its pieces for a scorer that takes windows; null or no piece for an
    empty text unless ``skip_empty`` is off."""
    if not getattr(scorer, "takes_windows", False):
        return F.nullif(text, F.lit("")) if skip_empty else text
    cut = pieces(text, max_chars)
    return cut if skip_empty else F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def best_probability(given: Column, terms: Sequence[str], scorer: Scorer) -> Column:
    """P(entailment) of a text by its ``premises``; null without one."""
    hyp = F.lit(hypothesis(terms))
    if getattr(scorer, "takes_windows", False):
        return scorer(given, hyp, terms)
    return F.when(given.isNotNull(), entailment_probability(scorer(given, hyp, terms)))


def entailment_probability(logits: Column) -> Column:
    """Softmax over [contradiction, entailment] -> P(entailment).  A scorer's
    array is taken apart by the optimizer, so nothing is evaluated twice."""
    return 1.0 / (1.0 + F.exp(F.get(logits, 0) - F.get(logits, 2)))


def entailment_labels(df: DataFrame, text: str, keys: Sequence[str],
                      topics: Mapping[str, Sequence[str]] = ENTAILMENT_TOPICS,
                      scorer: Scorer = term_share_scorer, threshold: float = ENTAILMENT_THRESHOLD,
                      max_chars: int = ENTAILMENT_MAX_CHARS, skip_empty: bool = True) -> DataFrame:
    """``keys``, per topic ``<topic>_p`` and ``<topic>`` (P >= threshold).
    Rows with an empty/null text are filtered before scoring (no model call)."""
    base = df.where(F.col(text).isNotNull() & (F.col(text) != "")) if skip_empty else df
    base = base.select(*keys, premises(F.col(text), scorer, max_chars, skip_empty).alias("_premises"))
    probs = [best_probability(F.col("_premises"), terms, scorer).alias(f"{name}_p") for name, terms in topics.items()]
    scored = base.select(*keys, *probs)
    return scored.select(*keys, *[c for name in topics for c in (
        F.col(f"{name}_p"), (F.col(f"{name}_p") >= threshold).alias(name))])


def entailment_bucket(p: Column) -> Column:
    """<= 0.4 contradiction, >= 0.6 entailment, else neutral."""
    return F.when(p <= 0.4, "contradiction").when(p >= 0.6, "entailment").otherwise("neutral")


def entailment_percent(p: Column) -> Column:
    return p * 100.0
