"""Lexicon sentiment (E1-E4) as in-row higher-order functions.

A text becomes an array of sentences, each sentence an array of tokens;
every token's valence is computed with ``transform`` over the token array,
looking back up to three tokens by index for boosters and negations (an
``aggregate`` over the distances keeps the sequential rule chain without
duplicating expressions).  Nothing is exploded and nothing is shuffled: an
article's score is a projection of its own row, so the cost is linear in the
text and independent of how articles are distributed.

Rules (published VADER method): lexicon valence; ALL-CAPS emphasis when the
sentence mixes case; boosters at distance 1-3 damped by 1 / 0.95 / 0.9;
negation at distance 1-3 (with the ``never so`` / ``without doubt`` cases);
``least``; ``kind of``; the ``but`` shift (0.5 before, 1.5 after);
``!``/``?`` emphasis; normalisation ``s / sqrt(s^2 + 15)`` rounded to 4 dp.
Tokens are whitespace splits longer than one character; an emoticon of the
table stays as it is, every other token loses its edge punctuation.  Before the
rules, the longest idiom that starts at a token becomes one token (leftmost
first), whose valence is the idiom's."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.config import lexicon as LX
from inkwell.functions.text import UNEVEN_SPACE, bind as _bind, literal_lookup, split_sentences

PUNCT = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
EDGE_PUNCT_RE = f"^[{PUNCT}]+|[{PUNCT}]+$"
PUNCT_CHARS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"   # same set, as plain characters


# Noncharacters that frame the tokens of a sentence while idioms are matched;
# a text's own are removed from sentences that hold an idiom's first word.
LOWER, UPPER, END, MARK = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
FRAME = LOWER + UPPER + END + MARK


def idiom_words(term: str) -> tuple[str, ...]:
    """The words of a term as texts show them: lower case, one-character words
    left out, edge punctuation stripped."""
    return tuple(w.lower().strip(PUNCT_CHARS) for w in term.split() if len(w) > 1)


def trie_regex(phrases: list[tuple[str, ...]]) -> str:
    """A pattern for the longest of the word sequences, one branch per word of
    their trie, over framed words (flag, word, END)."""
    trie: dict = {}
    for words in phrases:
        node = trie
        for w in words:
            node = node.setdefault(w, {})
        node[None] = {}

    def pattern(node: dict) -> str:
        branches = [f"[{LOWER}{UPPER}]{re.escape(w)}{END}{pattern(below)}" for w, below in sorted(
            (w, below) for w, below in node.items() if w is not None)]
        if not branches:
            return ""
        return f"(?:{'|'.join(branches)})" + ("?" if None in node else "")
    return pattern(trie)


def word_regex(words: Mapping[str, str]) -> str:
    """A pattern for any of the words and what has to follow it, one branch per
    character of their trie."""
    trie: dict = {}
    for word, after in words.items():
        node = trie
        for c in word:
            node = node.setdefault(c, {})
        node[None] = after

    def pattern(node: dict) -> str:
        branches = [re.escape(c) + pattern(below) for c, below in sorted(
            (c, below) for c, below in node.items() if c is not None)]
        return f"(?:{'|'.join(branches + [node[None]] if None in node else branches)})" if branches or None in node else ""
    return pattern(trie)


# No letter or digit beside a word, and what stands between two words.
NO_MORE, GAP = "(?![a-z0-9])", "[^a-z0-9]+"


def idiom_start_regex(seconds: Iterable[str]) -> str:
    """What follows an idiom's first word where it may be one: a second word,
    also after a word of one character, or two of those.  (A repeated group is
    many times slower.)"""
    return f"{NO_MORE}{GAP}(?:[a-z0-9]{GAP})?+(?:{word_regex(dict.fromkeys(seconds, NO_MORE))}|[a-z0-9]{NO_MORE})"


class Lexicon:
    """A valence table as one literal of the plan, however many terms.

    A term of several words is an idiom; a term that edge stripping would
    change is an emoticon; any other is a word.  An idiom of which fewer than
    two words remain (see ``idiom_words``) matches nothing."""

    def __init__(self, terms: list[str], values: list[float]):
        table = dict(zip(terms, values))
        phrases = {idiom_words(t): v for t, v in table.items() if len(t.split()) > 1}
        self.idioms = {w: v for w, v in phrases.items() if len(w) > 1}
        single = {t: v for t, v in table.items() if len(t.split()) == 1}
        self.emoticons = frozenset(t for t in single if t.strip(PUNCT_CHARS) != t)
        self.terms = frozenset(single)
        roots = {w[0] for w in self.idioms}
        self.lookup = literal_lookup(single | {" ".join(w): v for w, v in self.idioms.items()}, "double")
        self._entry = literal_lookup({t: {"value": single.get(t), "root": t in roots} for t in single.keys() | roots},
                                     "struct<value:double,root:boolean>")
        seconds: dict[str, set[str]] = {}
        for w in self.idioms:
            seconds.setdefault(w[0], set()).add(w[1])
        known = [*single, *roots, *(w for some in seconds.values() for w in some)]
        self._any = word_regex({w: idiom_start_regex(sorted(some)) for w, some in seconds.items()} | dict.fromkeys(single, NO_MORE)) \
            if all(w and w.isascii() for w in known) and all(w[0].isalnum() for some in seconds.values() for w in some) else None
        self._start = literal_lookup({" ".join(w[:3]): 1.0 for w in self.idioms}, "double")
        self._emoticon = literal_lookup(dict.fromkeys(self.emoticons, 1.0), "double")

    def contains(self, w: Column) -> Column:
        """Is the word a term, or the first of an idiom?"""
        return F.coalesce(self._entry(w).isNotNull(), F.lit(False))

    def may_know(self, sentence: Column) -> Column:
        """False only for a sentence that scores 0 for want of a term: a word's
        letters, with no letter or digit beside them, stand in the lowered text,
        and so do the first two words of an idiom (see ``idiom_start_regex``).
        Words beyond ASCII may change their case by what stands beside them, so
        a lexicon that has one lets every sentence through; so does a framing
        character, which is removed from within the words of an idiom."""
        if self._any is None:
            return F.lit(True)
        return F.lower(sentence).rlike(f"(?<![a-z0-9]){self._any}") | sentence.rlike(f"[{FRAME}]") if self._any else F.lit(False)

    def entries(self, words: Column) -> Column:
        """Per word (value, root): its valence, and whether it is the first of
        an idiom; null for any other word."""
        return F.transform(words, self._entry)

    def word(self, raw: Column) -> Column:
        """A token as the rules see it."""
        def lowered(bare: Column) -> Column:
            return F.when((bare != raw) & self._emoticon(F.lower(raw)).isNotNull(), F.lower(raw)).otherwise(F.lower(bare))
        bare = F.btrim(raw, F.lit(PUNCT_CHARS))
        return _bind(bare, lowered) if self.emoticons else F.lower(bare)

    def starts(self, words: Column, entries: Column) -> Column:
        """Do the first words of an idiom, up to three, stand side by side?"""
        def begun(e: Column, i: Column) -> Column:
            runs = (self._start(F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)])) for n in (2, 3))
            return F.when(e["root"], functools.reduce(Column.__or__, (r.isNotNull() for r in runs)))
        return F.exists(F.transform(entries, begun), lambda found: F.coalesce(found, F.lit(False)))

    def merged(self, st: Column) -> Column:
        """struct<words, raws, vals> of a staged sentence with every idiom as one
        token, whose raw form is in capitals if all its words are.  Only a
        sentence with the first words of one is searched; the first alone is
        enough where the text has a framing character."""
        words, raws, entries = st.getField("words"), st.getField("raws"), st.getField("entries")
        plain = F.struct(words.alias("words"), raws.alias("raws"), F.transform(entries, lambda e: e["value"]).alias("vals"))
        if not self.idioms:
            return plain
        framed = F.array_join(F.zip_with(words, raws, lambda w, r: F.concat(
            F.when(is_upper(r), UPPER).otherwise(LOWER), F.translate(w, FRAME, ""), F.lit(END))), "")
        marked = F.regexp_replace(framed, f"({trie_regex(list(self.idioms))})", f"{MARK}$1{MARK}")
        # idioms are the odd pieces between the marks
        pieces = F.transform(F.split(marked, MARK), lambda s, i: F.when(i % 2 == 1, F.array(s)).otherwise(
            F.filter(F.split(s, END), lambda t: t != "")))
        units = _bind(F.flatten(pieces), lambda units: _bind(
            F.transform(units, lambda t: F.btrim(F.translate(t, END + FRAME, " "))), lambda merged: F.struct(
                merged.alias("words"), F.transform(units, lambda t: F.when(t.contains(LOWER), "a").otherwise("A")).alias("raws"),
                F.transform(merged, self.lookup).alias("vals"))))
        framing = functools.reduce(Column.__or__, (st.getField("text").contains(c) for c in FRAME))
        first = F.exists(entries, lambda e: F.coalesce(e["root"], F.lit(False)))
        return F.when(F.when(framing, first).otherwise(self.starts(words, entries)), units).otherwise(plain)


def lexicon_map(lexicon: Mapping[str, float] | DataFrame | Lexicon | None = None) -> Lexicon:
    """Valence look-up of a mapping or of a ``(term, valence)`` table: a
    dictionary of words, which the driver reads whole."""
    if isinstance(lexicon, Lexicon):
        return lexicon
    if lexicon is None:
        lexicon = LX.DEFAULT_LEXICON | LX.EMOTICONS | LX.IDIOMS
    if isinstance(lexicon, DataFrame):
        lexicon = {r["term"]: r["valence"] for r in lexicon.select("term", "valence").where(
            "term is not null and valence is not null").collect()}
    items = sorted((k.lower(), float(v)) for k, v in lexicon.items())
    return Lexicon([k for k, _ in items], [v for _, v in items])


def booster_map() -> Lexicon:
    items = [(w, LX.B_INCR) for w in LX.BOOSTERS_UP] + [(w, LX.B_DECR) for w in LX.BOOSTERS_DOWN]
    return Lexicon([k for k, _ in items], [v for _, v in items])


def is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & (F.lower(c) != c)


def negated(w: Column) -> Column:
    return F.coalesce(w.isin(LX.NEGATIONS) | w.contains("n't"), F.lit(False))


def tokens(sentence: Column) -> Column:
    """Whitespace tokens longer than one character.  Whitespace runs are
    first normalised with ``regexp_replace`` (its literal pattern is compiled
    once) and then split on a single space, which avoids compiling a regex
    per sentence inside ``split``."""
    spaced = F.regexp_replace(sentence, UNEVEN_SPACE, " ")
    return F.filter(F.split(spaced, " "), lambda t: F.length(t) > 1)


def _token_score(st: Column, i: Column, lex: Lexicon) -> Column:
    """Score of token ``i``, one with a valence, of a sentence struct.  What the
    rules ask of the few tokens beside it is looked up here."""
    words, raws, vals = st.getField("words"), st.getField("raws"), st.getField("vals")
    cap_diff, but_pos = st.getField("cap_diff"), st.getField("but_pos")
    boost = booster_map()
    base = F.get(vals, i)
    caps = is_upper(F.get(raws, i)) & cap_diff
    v1 = F.when(caps, F.when(base > 0, base + LX.C_INCR).otherwise(base - LX.C_INCR)).otherwise(base)

    def negs(k):
        return negated(F.get(words, i - k))

    def prev(k):
        return F.get(words, i - k)

    def step(acc, d):
        j = i - d
        active = (i >= d) & F.get(vals, j).isNull()
        s0 = F.coalesce(boost.lookup(F.get(words, j)), F.lit(0.0))
        s1 = F.when(acc < 0, -s0).otherwise(s0)
        s2 = F.when((s0 != 0) & is_upper(F.get(raws, j)) & cap_diff,
                    F.when(acc > 0, s1 + LX.C_INCR).otherwise(s1 - LX.C_INCR)).otherwise(s1)
        damp = F.when(d == 2, LX.DAMPING[2]).when(d == 3, LX.DAMPING[3]).otherwise(LX.DAMPING[1])
        so_this = ["so", "this"]
        f1 = F.when(negs(1), LX.N_SCALAR).otherwise(1.0)
        f2 = (F.when((prev(2) == "never") & prev(1).isin(so_this), 1.25)
              .when((prev(2) == "without") & (prev(1) == "doubt"), 1.0)
              .when(negs(2), LX.N_SCALAR).otherwise(1.0))
        f3 = (F.when((prev(3) == "never") & (prev(2).isin(so_this) | prev(1).isin(so_this)), 1.25)
              .when((prev(3) == "without") & ((prev(2) == "doubt") | (prev(1) == "doubt")), 1.0)
              .when(negs(3), LX.N_SCALAR).otherwise(1.0))
        factor = F.coalesce(F.when(d == 1, f1).when(d == 2, f2).otherwise(f3), F.lit(1.0))
        return F.when(active, (acc + s2 * damp) * factor).otherwise(acc)

    v2 = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), v1, step)
    least_in_lex = F.lit("least" in lex.terms)
    least = F.when((prev(1) == "least") & ~least_in_lex,
                   F.when(i > 1, F.when(~F.coalesce(prev(2).isin("at", "very"), F.lit(False)),
                                        LX.N_SCALAR).otherwise(1.0))
                   .otherwise(LX.N_SCALAR)).otherwise(1.0)
    but = F.when(but_pos < 0, 1.0).when(i < but_pos, 0.5).when(i > but_pos, 1.5).otherwise(1.0)
    w = F.get(words, i)
    zero = (boost.lookup(w).isNotNull() | ((w == "kind") & F.coalesce(F.get(words, i + 1) == "of", F.lit(False))))
    return F.when(zero, F.lit(0.0)).otherwise(v2 * least * but)


def _count_char(s: Column, ch: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def _stage(texts: Column, lex: Lexicon) -> Column:
    """array<string> -> array<struct<text, raws, words, entries>>."""
    s1 = F.transform(texts, lambda s: F.struct(s.alias("text"), tokens(s).alias("raws")))
    s2 = F.transform(s1, lambda a: F.struct(
        a.getField("text").alias("text"), a.getField("raws").alias("raws"),
        F.transform(a.getField("raws"), lex.word).alias("words")))
    return F.transform(s2, lambda b: F.struct(
        *[b.getField(k).alias(k) for k in ("text", "raws", "words")], lex.entries(b.getField("words")).alias("entries")))


def _sentence(b: Column, lex: Lexicon) -> Column:
    """Tokens and valences of one staged sentence (run only when it holds a
    lexicon word or an idiom's first word), and what the rules ask of all of it."""
    def described(units):
        words, raws = units.getField("words"), units.getField("raws")
        return F.struct(b.getField("text").alias("text"), words.alias("words"), raws.alias("raws"),
                        units.getField("vals").alias("vals"),
                        (F.exists(raws, is_upper) & F.exists(raws, lambda r: ~is_upper(r))).alias("cap_diff"),
                        (F.array_position(words, "but") - 1).alias("but_pos"))
    return _bind(lex.merged(b), described)


def _sentence_score(b: Column, lex: Lexicon) -> Column:
    """A sentence without lexicon words or idioms sums to 0, and punctuation emphasis
    only applies to a non-zero sum, so its compound is exactly 0."""
    known = F.exists(b.getField("entries"), lambda e: e.isNotNull())
    return F.when(known, _bind(_sentence(b, lex), lambda st: _compound(st, lex))) \
        .otherwise(F.lit(0.0))


def _text_score(text: Column, lex: Lexicon) -> Column:
    """The score of one text; only one that may hold a lexicon word or an idiom
    is taken apart into its words."""
    return F.when(lex.may_know(text), F.get(F.transform(
        _stage(F.array(text), lex), lambda st: _sentence_score(st, lex)), 0)).otherwise(F.lit(0.0))


def _compound(st: Column, lex: Lexicon) -> Column:
    valued = F.filter(F.transform(st.getField("vals"), lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull())
    scores = F.transform(valued, lambda i: _token_score(st, i, lex))     # any other token scores 0
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    text = st.getField("text")
    ep = F.least(_count_char(text, "!"), F.lit(4)) * LX.EXCLAIM_WEIGHT
    qm = _count_char(text, "?")
    qa = F.when(qm > 1, F.when(qm <= 3, qm * LX.QUESTION_WEIGHT).otherwise(LX.QUESTION_CAP)).otherwise(0.0)
    punct = ep + qa

    def finish(t):
        return _bind(F.when(t > 0, t + punct).when(t < 0, t - punct).otherwise(t), lambda s: F.round(
            F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s / F.sqrt(s * s + LX.NORM_ALPHA))), 4))
    return _bind(total, finish)


def sentence_scores(text: Column, lex: Lexicon | None = None) -> Column:
    """E1+E2: array<struct<sentence, compound>> for a text (regex sentence
    split, blanks dropped)."""
    lex = lexicon_map() if lex is None else lex
    return F.transform(split_sentences(text), lambda s: F.struct(
        s.alias("sentence"), _text_score(s, lex).alias("compound")))


def list_scores(texts: Column, lex: Lexicon | None = None) -> Column:
    """E2 on an array of texts taken as given (no sentence split)."""
    lex = lexicon_map() if lex is None else lex
    return F.transform(texts, lambda s: _text_score(s, lex))


def sentence_compound(sentence: Column, lex: Lexicon | None = None) -> Column:
    """Compound score of one text taken as a single sentence."""
    return F.get(list_scores(F.array(sentence), lex), 0)


def mean_of(values: Column) -> Column:
    """Mean of an array of doubles; empty -> null."""
    return _bind(values, lambda v: F.when(F.size(v) > 0, F.aggregate(
        v, F.lit(0.0), lambda a, x: a + x) / F.size(v)))


def sentiment_label(score: Column) -> Column:
    """(0.1, 0.5) mildy_positive; >= 0.5 positive; (-0.5, -0.1)
    mildy_negative; <= -0.5 negative; else neutral (label spelling kept).
    The score is bound once, so an expensive score expression is not
    re-evaluated by each branch."""
    return _bind(score, lambda s: F.when((s > 0.1) & (s < 0.5), "mildy_positive")
                 .when(s >= 0.5, "positive")
                 .when((s < -0.1) & (s > -0.5), "mildy_negative")
                 .when(s <= -0.5, "negative")
                 .otherwise("neutral"))
