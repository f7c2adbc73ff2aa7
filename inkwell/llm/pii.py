"""Personal data: patterns propose spans, validators confirm them, nearby
context words adjust the score.

Everything is DataFrame expressions over whole texts.  A text is split by a
pattern into the gaps between its matches; the running lengths of gaps and
matches are the spans, in code points.  Patterns only start where a run of
their first characters starts and give nothing back, so a text is read once
per pattern however long its runs are.

Base kinds (email, ip, card, phone) always stay; further kinds count when
their score reaches ``MIN_SCORE`` and no base span overlaps them.

Defined results: a null text counts as empty and has no spans; repeated rows
each get their row; an empty table gives no rows.  Only the named columns are
read, so extra columns never clash; ``redact`` returns all columns as they are
but for the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import bind

MIN_SCORE = 0.5
#: What a context word adds, and the code points before and behind a match
#: that are searched for one (up to the next match of the same kind).
CONTEXT_BONUS, BEFORE, BEHIND = 0.4, 40, 20

_NONE = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


#: Characters of an IBAN by its country code, after the SWIFT registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}


def iban_pattern(lengths: dict[int, str] = IBAN_LENGTHS) -> str:
    """The country code says where an IBAN ends, so no word behind it is read;
    with another code it goes on as long as it can.  No IBAN goes on over the
    start of an entire one of a known country."""
    def whole(gap: str) -> str:
        return "|".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:{gap}[A-Z0-9]){{{n - 4}}}" for n, codes in lengths.items())

    gap = rf"(?:\x20(?!(?:{whole(r'\x20?')})(?![A-Za-z0-9])))?"
    known = " ".join(lengths.values()).replace(" ", "|")
    return (rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{whole(gap)}|(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:{gap}[A-Z0-9]){{11,30}}+)"
            r"(?![A-Za-z0-9])")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a digit string."""
    def weighed(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    from_right = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    values = F.transform(F.transform(from_right, lambda c: c.cast("int")), weighed)
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod97(code: Column) -> Column:
    """IBAN checksum: the code with its first four characters moved behind
    and letters as numbers from 10 leaves 1 modulo 97."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        value = F.ascii(c) - F.when(F.ascii(c) >= 65, F.lit(55)).otherwise(F.lit(48))
        return (rest * F.when(value > 9, F.lit(100)).otherwise(F.lit(10)) + value) % 97

    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), step) == 1


def _ip(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _card(match: Column) -> Column:
    return bind(_digits(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _iban(match: Column) -> Column:
    return bind(F.replace(match, F.lit(" "), F.lit("")),
                lambda c: F.when(F.length(c).between(15, 34), mod97(c)).otherwise(False))


def _any(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """``starts``: a string that every match holds, or none; ``score``: of a
    confirmed match without a context word."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    words: tuple[str, ...]
    starts: str = ""


#: The base kinds, in the order of the results.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.9,
         ("mail", "email", "e-mail", "contact", "correo", "courriel"), "@"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+", _ip, 0.6, ("ip", "host", "server", "address", "client"), "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.6, ("card", "visa", "mastercard", "credit", "debit", "karte", "carte", "tarjeta")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6,
         ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"), "+"),
)

#: What the method adds to them.
ADDED = (
    Kind("iban", iban_pattern(), _iban, 0.8, ("iban", "account", "konto", "compte", "cuenta")),
    Kind("local_phone", r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", _any, 0.3,
         ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono")),
    Kind("social_security", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", _any, 0.3,
         ("ssn", "social security", "social-security", "taxpayer")),
)


def _pieces(text: Column, kind: Kind, body: Callable[[Column, Column], Column], none: Column) -> Column:
    """``body(matches, gaps)`` where the kind has a match, else ``none``; there
    is one gap more than matches."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    found = bind(matches, lambda m: F.when(F.size(m) == 0, none).otherwise(
        bind(F.split(text, kind.pattern, -1), lambda gaps: body(m, gaps))))
    return F.when(text.contains(kind.starts), found).otherwise(none) if kind.starts else found


def _score(kind: Kind, gaps: Column, i: Column) -> Column:
    near = F.concat(F.right(gaps[i], F.lit(BEFORE)), F.lit(" "), F.left(gaps[i + 1], F.lit(BEHIND)))
    named = F.lower(near).rlike(r"(?<![\p{L}])(?:" + "|".join(kind.words) + r")(?![\p{L}])")
    return F.least(F.lit(1.0), F.lit(kind.score) + F.when(named, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0)))


def _powers(n: Column, falling: bool = False) -> Column:
    """1, 2, 4, ... below ``n``."""
    every = [1 << k for k in range(31)]
    return F.filter(F.array(*map(F.lit, reversed(every) if falling else every)), lambda p: p < n)


def running_sums(values: Column) -> Column:
    """Sums of an array up to each element, by doubling: no array grows, so
    the work is n log n."""
    def step(at: Column, span: Column) -> Column:
        return F.transform(at, lambda v, i: v + F.when(i >= span, at[F.greatest(i - span, F.lit(0))]).otherwise(F.lit(0)))

    return bind(values, lambda v: F.aggregate(_powers(F.size(v)), v, step))


def spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans (kind, start, end, score) of one kind, by start."""
    def body(matches: Column, gaps: Column) -> Column:
        steps = F.transform(matches, lambda m, i: (F.length(gaps[i]) + F.length(m)).cast("bigint"))
        return bind(running_sums(steps), lambda ends: F.filter(
            F.transform(matches, lambda m, i: F.when(kind.confirm(m), F.struct(
                F.lit(kind.name).alias("kind"), (ends[i] - F.length(m)).alias("start"), ends[i].alias("end"),
                _score(kind, gaps, i).alias("score")))), lambda s: s.isNotNull()).cast(_NONE))

    return _pieces(text, kind, body, F.array().cast(_NONE))


def _overlapped(span: Column, spans: Column) -> Column:
    """Whether one of ``spans`` (by start, apart from each other) shares a code
    point with ``span``: a binary search for the last one that starts before
    its end."""
    def step(before: Column, more: Column) -> Column:
        at = before + more
        starts_before = F.when(at <= F.size(spans), spans[F.least(at, F.size(spans)) - 1]["start"] < span["end"]).otherwise(False)
        return F.when(starts_before, at).otherwise(before)

    last = F.aggregate(_powers(F.size(spans) + 1, falling=True), F.lit(0), step)
    return bind(last, lambda n: F.when(n > 0, spans[F.greatest(n, F.lit(1)) - 1]["end"] > span["start"]).otherwise(False))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, one column of spans for each base kind, added): all spans of
    each row with their scores."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *[spans(text, k).alias(k.name) for k in BASE],
                       F.concat(*[spans(text, k) for k in ADDED]).alias("proposed"))
    clear = F.filter("proposed", lambda s: (s["score"] >= MIN_SCORE) & ~reduce(
        lambda a, b: a | b, [_overlapped(s, F.col(k.name)) for k in BASE]))
    return rows.select("doc_id", *[k.name for k in BASE],
                       F.when(F.size("proposed") > 0, clear).otherwise(F.col("proposed")).alias("added"))


def as_text(*columns: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(F.concat(*map(F.col, columns)),
                                    lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _without(text: Column, kind: Kind) -> Column:
    def body(matches: Column, gaps: Column) -> Column:
        def piece(gap: Column, i: Column) -> Column:
            match = F.coalesce(F.get(matches, i), F.lit(""))
            seen = kind.confirm(match) & (_score(kind, gaps, i) >= MIN_SCORE)
            return F.concat(gap, F.when(i >= F.size(matches), F.lit("")).otherwise(
                F.when(seen, F.lit(f"[{kind.name.upper()}]")).otherwise(match)))

        return F.array_join(F.transform(gaps, piece), "")

    return bind(text, lambda t: _pieces(t, kind, body, t))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets, one kind after
    the other; a null text stays null."""
    email, ip, card, phone = BASE
    order = (email, *ADDED[:1], phone, card, ip, *ADDED[1:])
    return docs.withColumn(text_col, reduce(_without, order, F.col(text_col)))
