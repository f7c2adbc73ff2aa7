"""Licence scan: canonical digest lookup.

A text is normalised (ASCII case, punctuation, copyright lines, equivalent
spellings) and its SHA-256 is joined to the digests of known licence texts.
Both the entire document and each of its lines count as an entire text, so a
document that is a licence and a document that carries a notice line are told
apart.

Defined results: a null text is the empty text; a text without a letter or
digit has the digest of the empty string and matches nothing; repeated rows
each get their row; an empty table gives no rows.  Only the named columns are
read, so extra columns never clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import literal_lookup
from inkwell.llm.common import lower_ascii
from inkwell.llm.licence_texts import EQUIVALENT_SPELLINGS, KNOWN_TEXTS

#: A normalised line that only names a copyright holder.
COPYRIGHT_LINE = r"^(copyright( |$)|c [0-9]{4}( |$)|all rights reserved$)"


def normalised_lines(text: Column) -> Column:
    """The non-empty normalised lines of a text, copyright lines left out."""
    marked = F.replace(F.coalesce(text, F.lit("")), F.lit("©"), F.lit(" c "))
    c = F.regexp_replace(lower_ascii(marked), r"[^\p{L}\p{N}\n]+", " ")
    c = reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), EQUIVALENT_SPELLINGS, c)
    lines = F.transform(F.split(c, "\n", -1), lambda line: F.trim(line))
    return F.filter(lines, lambda line: (line != "") & ~line.rlike(COPYRIGHT_LINE))


def digest(normalised: Column) -> Column:
    return F.sha2(normalised.cast("binary"), 256)


def known_licences(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN_TEXTS) -> DataFrame:
    """(known_digest, licence): one row per distinct digest."""
    df = spark.createDataFrame(texts, "licence string, text string")
    return (df.select(digest(F.array_join(normalised_lines(F.col("text")), " ")).alias("known_digest"), "licence")
            .groupBy("known_digest").agg(F.min("licence").alias("licence")))


def licence_scan(docs: DataFrame, texts: list[tuple[str, str]] = KNOWN_TEXTS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: ``digest`` of the entire normalised text, the
    ``licence`` it equals (or null), and ``notices``: the sorted licences that
    entire lines of it equal, comma-joined.

    The known texts are a list of the program, so their digests are broadcast
    whatever the size of ``docs``, and no row of ``docs`` is shuffled."""
    known = known_licences(docs.sparkSession, texts)
    name = literal_lookup({r["known_digest"]: r["licence"] for r in known.collect()}, "string")
    lines = docs.select(F.col(id_col), normalised_lines(F.col(text_col)).alias("lines"))
    hashed = lines.select(id_col, digest(F.array_join("lines", " ")).alias("digest"),
                          F.array_distinct(F.transform("lines", digest)).alias("line_digests"))
    hits = F.filter(F.transform("line_digests", name), lambda licence: licence.isNotNull())
    return (hashed.join(F.broadcast(known), F.col("digest") == F.col("known_digest"), "left")
            .select(id_col, "digest", "licence",
                    F.array_join(F.array_sort(F.array_distinct(hits)), ",").alias("notices")))


def oracle(texts: list[tuple[str, str]] = KNOWN_TEXTS) -> str:
    """The same rows as DuckDB SQL over ``documents``."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def lines(col: str) -> str:
        c = (f"regexp_replace(translate(replace(coalesce({col}, ''), '©', ' c '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             f"'abcdefghijklmnopqrstuvwxyz'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')")
        for was, now in EQUIVALENT_SPELLINGS:
            c = f"replace({c}, {quoted(was)}, {quoted(now)})"
        return (f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x, ' ')), "
                f"lambda x: x <> '' and not regexp_matches(x, {quoted(COPYRIGHT_LINE)}))")

    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in texts)
    return f"""
with given(licence, body) as (values {rows}),
known as (select sha256(array_to_string({lines('body')}, ' ')) known_digest, min(licence) licence from given group by 1),
doc as (select doc_id, {lines('text')} lines from documents),
hashed as (select row_number() over () rid, doc_id, sha256(coalesce(array_to_string(lines, ' '), '')) digest, lines from doc),
hit as (select rid, string_agg(distinct k.licence, ',' order by k.licence) notices
        from (select rid, unnest(lines) line from hashed) l join known k on sha256(l.line) = k.known_digest group by rid)
select h.doc_id, h.digest, k.licence, coalesce(hit.notices, '') notices
from hashed h left join known k on h.digest = k.known_digest left join hit on hit.rid = h.rid
"""
