"""Text cleaning as Column expressions (JVM-side; values bound once are
lambda variables, which Spark evaluates outside whole-stage codegen).

HTML to text is a fixed sequence of regex rewrites: drop comments and
script/style bodies, replace listed tag blocks, strip remaining tags, decode
entities, collapse whitespace.  Python's ``str.split()``
whitespace set is spelled out so every engine agrees (Java ``\\s`` alone
misses NBSP)."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters Python's str.split() splits on.
WHITESPACE_CLASS = (r"[\t\n\x0B\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}"
                    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same as a Java pattern whose first operand settles printable ASCII
# characters by one range test.
WHITESPACE = rf"[[\x{{00}}-\x{{20}}\x{{7F}}-\x{{FFFF}}]&&{WHITESPACE_CLASS}]"
# A run of whitespace that is not a single space already.
UNEVEN_SPACE = rf"(?:[{WHITESPACE}&&[^ ]]{WHITESPACE}*| {WHITESPACE}+)"

COMMENT_RE = r"(?s)<!--.*?-->"
SCRIPT_RE = r"(?is)<script\b[^>]*>.*?</script\s*>"
STYLE_RE = r"(?is)<style\b[^>]*>.*?</style\s*>"
TAG_RE = r"</?[A-Za-z!][^>]*>"

ENTITY_RE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# Numeric references to the C1 range mean Windows-1252 characters in HTML.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_WINDOWS = "".join(bytes([ord(c)]).decode("cp1252", "ignore") or c for c in _C1)


def literal_lookup(items: Mapping[str, object], kind: str):
    """A look-up in a dictionary that is one literal of the plan: buckets of
    keys by CRC-32 (about one key each), parsed once by constant folding.
    Returns Column -> Column, null for an unknown key."""
    size = max(1, len(items))
    buckets: list[dict[str, object]] = [{} for _ in range(size)]
    for key, value in items.items():
        buckets[zlib.crc32(key.encode()) % size][key] = value
    literal = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")
    return lambda key: F.try_element_at(F.get(literal, (F.crc32(key.cast("binary")) % size).cast("int")), key)


def tag_block_regex(tags: Iterable[str]) -> str | None:
    """``<t.*?>(.*?)</t>`` per tag, alternated.  ``.`` does not cross a
    newline (``(?d)``: only ``\\n`` ends a line, as in Python)."""
    tags = list(tags)
    if not tags:
        return None
    return "(?d)" + "|".join(f"<{t}.*?>(.*?)</{t}>" for t in tags)


def remove_tag_blocks(col: Column, tags: Iterable[str] = ()) -> Column:
    """Replace every listed tag block by two spaces; empty list = identity."""
    rx = tag_block_regex(tags)
    return col if rx is None else F.regexp_replace(col, rx, "  ")


def _entity(e: Column, named) -> Column:
    """The character(s) of one entity; an unknown name stays as it is."""
    body = F.substr(e, F.lit(2), F.length(e) - 2)
    code = F.when(body.rlike("^#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10).cast("bigint")) \
        .when(body.startswith("#"), F.substr(body, F.lit(2)).cast("bigint"))
    char = F.when((code < 1) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd")).otherwise(
        F.translate(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"), _C1, _WINDOWS))
    return F.when(body.startswith("#"), char).otherwise(F.coalesce(named(body), e))


def decode_entities(col: Column) -> Column:
    """Decode every numeric and named character reference once (so
    ``&amp;lt;`` becomes ``&lt;``): the text is split at the references and put
    together again with what they stand for."""
    named = literal_lookup({k[:-1]: v for k, v in html5.items() if k.endswith(";")}, "string")

    def join(found, gaps):
        piece = lambda gap, i: F.concat(gap, F.coalesce(_entity(F.get(found, i), named), F.lit("")))
        return F.array_join(F.transform(gaps, piece), "")

    return bind(F.regexp_extract_all(col, F.lit(ENTITY_RE), F.lit(0)), lambda found: F.when(F.size(found) == 0, col).otherwise(
        bind(F.split(col, ENTITY_RE, -1), lambda gaps: join(found, gaps))))


def collapse_whitespace(col: Column) -> Column:
    """``' '.join(s.split())``."""
    return F.trim(F.regexp_replace(col, UNEVEN_SPACE, " "))


def strip_markup(col: Column) -> Column:
    """Remove comments, script/style bodies and tags; like a parser's text
    view, tags are removed without inserting spaces."""
    col = F.regexp_replace(col, COMMENT_RE, "")
    col = F.regexp_replace(col, SCRIPT_RE, "")
    col = F.regexp_replace(col, STYLE_RE, "")
    return F.regexp_replace(col, TAG_RE, "")


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable, so
    an expensive input referenced several times is computed once."""
    return F.get(F.transform(F.array(value), fn), 0)


def clean_html(col: Column, tags_to_remove: Iterable[str] = ()) -> Column:
    """B9 cleaner: tag blocks -> markup strip -> entities -> whitespace.
    The markup passes run only on texts containing ``<`` and the entity
    passes only on texts containing ``&`` (same result, far fewer scans)."""
    def markup(x):
        return F.when(x.contains("<"), strip_markup(x)).otherwise(x)

    def entities(x):
        return F.when(x.contains("&"), decode_entities(x)).otherwise(x)

    return bind(remove_tag_blocks(col, tags_to_remove),
                lambda a: bind(markup(a), lambda b: collapse_whitespace(entities(b))))


# ---------------------------------------------------------------------------
# Sentences and tokens
# ---------------------------------------------------------------------------
SENTENCE_BREAK = "\u0001"


def split_sentences(col: Column) -> Column:
    """Prose splitter: break after ``.``, ``!`` or ``?`` followed by
    whitespace; the punctuation stays with its sentence; blank pieces are
    dropped."""
    marked = F.regexp_replace(col, r"([.!?])" + WHITESPACE + "+",
                              "$1" + SENTENCE_BREAK)
    parts = F.split(marked, SENTENCE_BREAK)
    return F.filter(parts, lambda s: F.length(F.trim(s)) > 0)


def split_on_period(col: Column) -> Column:
    """Literal split on ``.`` keeping empty fragments (``str.split('.')``)."""
    return F.split(col, r"\.", -1)


def explode_indexed(df, keys, array_col, pos: str = "pos", value: str = "value"):
    """``posexplode`` without the inferred ``size(array) > 0`` pre-filter:
    Catalyst would push that filter below the projection and evaluate an
    expensive array expression twice.  ``posexplode_outer`` plus a filter on
    the position keeps one evaluation (empty and null arrays yield no row)."""
    out = df.select(*keys, F.posexplode_outer(array_col).alias(pos, value))
    return out.where(F.col(pos).isNotNull())
