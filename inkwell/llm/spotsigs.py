"""SpotSigs document fingerprints.

A spot signature is a common word (the anchor) with the chain of content words
that follow it; a text's fingerprint is the set of its signatures' hashes.
Sets are compared by Jaccard likeness; sets whose lengths differ too much for
a threshold are pruned unseen, which ``similar_pairs`` uses to partition by
set length.

Everything is DataFrame expressions.  Words are runs of letters and digits,
lower-cased.

Defined results: a null text counts as empty; a text without a full chain has
one signature, the hash of its whole word sequence, so texts of no signature
are alike only if their words are equal; repeated rows each get their row; an
empty table gives no rows.  Only the named columns are read, so extra columns
never clash.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import bind

#: Content words of a chain, and how many content words further each next one is.
CHAIN, DISTANCE = 2, 1

#: Common words of English, French, German and Spanish.
ANCHORS = sorted(set("""
a about all an and are as at be been but by can do for from had has have he her his if in into is it its
no not of on one or our she so that the their there they this to was we were what which who will with
would you your
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou
par pas plus pour qu que qui sa se ses si son sur un une vous
aber als am auch auf aus bei das dem den der des die dieser durch ein eine einem einen einer er es für
hat ich im in ist mit nach nicht noch nur oder sich sie sind so um und uns unter von vor war wie wir zu
zum zur über
al como con del el ella en era es esta este fue ha hay la las lo los me mi muy más no nos o para pero
por que se sin sobre su sus también te un una unos y ya
""".split()))

_MARK = "\x01"


def signatures(text: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> Column:
    """Sorted distinct hashes of the text's spot signatures."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    reach = 1 + (chain - 1) * distance

    def of_words(joined: Column) -> Column:
        # "anchor anchor content anchor content" becomes one string per content
        # word, with the anchors behind it; the first string has those before any
        marked = F.array_join(F.transform(F.split(joined, " "), lambda w: F.concat(
            F.when(w.isin(anchors), F.lit(_MARK)).otherwise(F.lit(" ")), w)), "")
        return bind(F.split(marked, " "), lambda groups: bind(
            F.transform(groups, lambda g: F.substring_index(g, _MARK, 1)), lambda heads: of_groups(joined, groups, heads)))

    def of_groups(joined: Column, groups: Column, heads: Column) -> Column:
        def spots(group: Column, k: Column) -> Column:
            following = [F.get(heads, k + 1 + i * distance) for i in range(chain)]
            return F.when((F.instr(group, _MARK) > 0) & (k + reach < F.size(heads)),
                          F.transform(F.slice(F.split(group, _MARK), F.lit(2), F.length(group)),
                                      lambda a: F.xxhash64(a, *following))).otherwise(none)

        none = F.array().cast("array<bigint>")
        found = F.flatten(F.transform(groups, spots))
        return bind(found, lambda f: F.when(F.size(f) > 0, F.array_sort(F.array_distinct(f)))
                     .otherwise(F.array(F.xxhash64(joined))))

    return bind(words, of_words)


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 where the set lengths alone
    put it below ``threshold``, which is then not computed."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    exact = bind(F.size(F.array_intersect(a, b)), lambda both: both / (F.size(a) + F.size(b) - both))
    return F.when(shorter < threshold * longer, F.lit(0.0)).otherwise(exact)


def as_text(signature_set: Column) -> Column:
    """The set as one string: 16 hex digits a signature, comma-joined."""
    return F.array_join(F.transform(signature_set, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), ",")


def similar_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, likeness) for all a < b of ``sets(id bigint, signatures)``, one
    row per id, whose likeness is at least ``threshold`` (over 0).

    Sets are partitioned by length in bands of ratio ``threshold``, so partners
    are in the same or the next band; within a band they meet on one of the
    rarest signatures (a set of n and a partner share one of the n -
    ceil(threshold n) + 1 rarest).  Fold equal sets into one id beforehand:
    every pair found here is a true link or a verified candidate."""
    length = F.size("signatures")
    band = F.floor(F.log(length) / F.lit(-log(threshold)) + 1e-9) if threshold < 1 else length
    sized = sets.select("id", "signatures", F.size("signatures").alias("n"), band.cast("bigint").alias("band"))
    each = sized.select("id", "n", "band", F.explode("signatures").alias("s"))
    common = each.groupBy("s").agg(F.count("*").alias("docs"))
    ranked = (each.join(common, "s").groupBy("id", "n", "band")
              .agg(F.array_sort(F.collect_list(F.struct("docs", "s"))).alias("by_rarity")))
    rare = ranked.select("id", "n", "band", F.explode(F.transform(
        F.slice("by_rarity", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")),
        lambda x: x["s"])).alias("s"))
    left = rare.select(F.col("id").alias("x"), F.col("n").alias("nx"), "s",
                       F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    right = rare.select(F.col("id").alias("y"), F.col("n").alias("ny"), "s", "band")
    fits = (F.col("nx") <= F.col("ny")) & (F.col("nx") >= F.col("ny") * threshold - 1e-9) & (
        (F.col("nx") < F.col("ny")) | (F.col("x") < F.col("y")))
    pairs = left.join(right, ["s", "band"]).filter(fits).select("x", "y").distinct()
    a = sets.select(F.col("id").alias("x"), F.col("signatures").alias("sx"))
    b = sets.select(F.col("id").alias("y"), F.col("signatures").alias("sy"))
    return (pairs.join(a, "x").join(b, "y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                    likeness(F.col("sx"), F.col("sy"), threshold).alias("likeness"))
            .filter(F.col("likeness") >= threshold - 1e-12))


def with_tail_of(text: Column, other: Column) -> Column:
    """``text`` with its last third of code points (rounded down) replaced by
    the first as many, or all, of ``other``."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - third), F.substr(other, F.lit(1), third))
