"""URL filter: host and path rules, and boosted trees on lexical features.

The longest rule that fits a URL decides; the others go to gradient-boosted
trees over lexical features of the URL (lengths, depth, digit ratio, entropy,
parameter counts, statistics of the host's suffix), trained from labelled URLs.

The labels are a rule, not judgements: a URL counts as bad if a word of a
blocklist is a label of its host, a part of one between hyphens, or a word of
its path, digits at its end aside, or if one of the list's unmistakable words
is anywhere in a label (``bestcasino1``).  Trees are fitted on a bounded
sample, the ``sample_rows`` URLs of each class with the smallest hash of
(url, page_id).  Suffix statistics cover every row: how many URLs have the
host's last label, and how many distinct hosts are below its last two labels.

Defined results: a null URL, or one without ``://``, has an empty host and
path; where the sample has no two classes the trees allow everything; repeated
rows each get their row; an empty table gives no rows.  Only the named columns
are read, so extra columns never clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import bind
from inkwell.llm.common import lower_ascii, written

#: (verdict, host, path prefix).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: FIXED VALUES: usual words of the categories that URL blocklists have (adult,
#: gambling, drugs, advertising, spam, malware, piracy).
BLOCKLIST_WORDS = ["ads", "adserver", "adult", "adware", "bet", "bets", "betting", "bingo", "blackjack", "botnet", "casino", "cialis",
                   "clickbait", "cracked", "doubleclick", "escort", "escorts", "gambling", "hentai", "jackpot", "keygen", "lottery",
                   "malware", "milf", "nude", "phishing", "pills", "poker", "popunder", "porn", "porno", "roulette", "sex", "slots",
                   "spam", "spyware", "steroids", "tramadol", "viagra", "warez", "webcams", "xanax", "xxx"]
#: Those that no other word holds.
BLOCKLIST_PARTS = ["adserver", "blackjack", "botnet", "casino", "doubleclick", "gambling", "hentai", "jackpot", "malware", "phishing",
                   "popunder", "porno", "roulette", "spyware", "tramadol", "viagra", "warez"]

#: Sampled URLs of each class.
SAMPLE_ROWS = 5_000
TREES, DEPTH, SEED = 12, 4, 6
FEATURES = ["url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio", "hyphens", "entropy",
            "parameters", "query_length", "has_fragment", "longest_label", "first_label_length", "first_label_hyphens",
            "vowel_ratio", "suffix_urls", "domain_hosts"]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, or null."""
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in reversed(longest_first):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character of the characters' own distribution."""
    def of_chars(chars: Column) -> Column:
        n = F.size(chars)
        shares = F.transform(F.array_distinct(chars), lambda c: (
            (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n).cast("double"))
        return F.when(n == 0, F.lit(0.0)).otherwise(
            F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))))

    return bind(F.filter(F.split(text, ""), lambda c: c != ""), of_chars)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages(host, path, url, ...)`` with the features of each URL alone."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    first = F.coalesce(F.get(F.filter(labels, lambda x: ~x.isin("www", "m", "blog")), 0), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    rows = pages.withColumns({"labels": labels, "first_label": first, "query": query})

    def kept(text: Column, pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("double")

    length = F.greatest(F.length(url), F.lit(1))
    return rows.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "host_labels": F.size("labels").cast("double"),
        "path_depth": kept(path, "[^/]"), "digit_ratio": kept(url, "[^0-9]") / length, "hyphens": kept(host, "[^-]"),
        "entropy": entropy(url), "parameters": kept(F.col("query"), "[^=]"), "query_length": F.length("query").cast("double"),
        "has_fragment": url.contains("#").cast("double"),
        "longest_label": F.coalesce(F.array_max(F.transform("labels", lambda x: F.length(x))), F.lit(0)).cast("double"),
        "first_label_length": F.length("first_label").cast("double"), "first_label_hyphens": kept(F.col("first_label"), "[^-]"),
        "vowel_ratio": kept(F.col("first_label"), "[^aeiou]") / F.greatest(F.length("first_label"), F.lit(1)),
        "suffix": F.coalesce(F.try_element_at(F.col("labels"), F.lit(-1)), F.lit("")),
        "domain": F.substring_index("host", ".", -2),
    })


def listed(words: list[str], parts: list[str] = BLOCKLIST_PARTS) -> Column:
    """The blocklist's label of a URL: one of the words in its host or path,
    or one of ``parts`` inside a label of its host."""
    one, within = "(?:" + "|".join(sorted(words)) + ")", "|".join(sorted(parts))
    host, path = F.col("host"), lower_ascii(F.col("path"))
    return (host.rlike(rf"(?:^|[.-]){one}[0-9]*(?:[.:-]|$)") | host.rlike(within)
            | path.rlike(rf"(?<![\p{{L}}\p{{N}}]){one}[0-9]*(?![\p{{L}}\p{{N}}])"))


def with_features(pages: DataFrame) -> DataFrame:
    """All rows with their features.  Counts per suffix and domain are
    pre-aggregated and joined back; AQE splits the rows of a common one."""
    rows = lexical(pages)
    suffixes = rows.groupBy("suffix").agg(F.log1p(F.count("*")).alias("suffix_urls"))
    domains = rows.groupBy("domain").agg(F.log1p(F.approx_count_distinct("host")).alias("domain_hosts"))
    return rows.join(suffixes, "suffix").join(domains, "domain")


def train(rows: DataFrame, words: list[str] = BLOCKLIST_WORDS, sample_rows: int = SAMPLE_ROWS) -> PipelineModel | None:
    """Boosted trees on the sample, or None without two classes."""
    marked = rows.filter("host <> ''").select("url", "page_id", *FEATURES, listed(words).cast("double").alias("label"))
    order = F.xxhash64("url", "page_id"), "url", "page_id"
    picked = [marked.filter(F.col("label") == x).orderBy(*order).limit(sample_rows) for x in (0.0, 1.0)]
    both = written(reduce(DataFrame.unionByName, picked), "url-sample")
    if both.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    trees = GBTClassifier(labelCol="label", featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    return PipelineModel([assembler, trees.fit(assembler.transform(both.coalesce(1).sortWithinPartitions("url", "page_id")))])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, words: list[str] = BLOCKLIST_WORDS,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row."""
    urls = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = written(with_features(urls).select("page_id", "url", "host", "path", *FEATURES), "url-features")
    model = train(rows, words, sample_rows)
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    ruled = scored.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    learned = F.when((F.col("score") >= 0.5) & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"),
                        F.coalesce("ruled.verdict", learned).alias("verdict"), "score")
