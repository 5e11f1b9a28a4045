"""URL filter: rules by host and path, and boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones. The trees learn from a bounded sample of them; the
suffix statistics, smoothed block rates of host suffixes and of first path segments, count all of them. Both verdicts weigh the same.

Cases: a null url, or one without "://", has an empty host and path and is judged by the trees; repeated
rows are judged each; among rules of equal length the first in text order wins; without labelled URLs of
both verdicts all others get the verdict of the labelled ones, or ``allow``; an empty table gives no rows. Columns of
``pages`` other than ``url`` are kept by ``judge``, except those it makes itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import spread_sample, stored, table

ALLOW, BLOCK = "allow", "block"
RULES = ((ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"))
#: Labelled URLs that the trees learn from, about, at most; trees, and levels of each.
SAMPLE, TREES, LEVELS = 50_000, 20, 4
#: Labelled URLs of undecided verdict that each suffix is taken to have besides its own.
PRIOR = 20.0
#: Parts of the labelled hosts, for rates without a row's own labels.
FOLDS = 5

PARTS = ("host", "path")
FEATURES = (
    "length", "host_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy", "parameters",
    "query_length", "hyphens", "https", "fragment", "longest_label", "suffix_rate", "segment_rate",
)
MADE = (*PARTS, "rule", "verdict", "blocked")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    choices = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, slash, below = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + below)
        choices.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*choices)


def entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def lexical(parsed: DataFrame) -> DataFrame:
    """``parsed`` with the features that a URL has by itself."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"[?]([^#]*)", 1)
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", "")) / F.greatest(F.length(c), F.lit(1))
    labels = F.split(host, "[.]")
    return parsed.withColumns({
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "labels": F.size(labels).cast("double"),
        "digit_ratio": digits(url),
        "host_digit_ratio": digits(host),
        "entropy": entropy(url),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "query_length": F.length(query).cast("double"),
        "hyphens": F.length(F.regexp_replace(host, "[^-]", "")).cast("double"),
        "https": url.startswith("https:").cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "longest_label": F.array_max(F.transform(labels, F.length)).cast("double"),
        "suffix": _suffix(host),
        "segment": F.coalesce(F.get(F.split(path, "/"), F.lit(1)), F.lit("")),
    })


def _fold() -> Column:
    return F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")


def rates(labelled: DataFrame) -> DataFrame:
    """Stored block counts: what (suffix or segment), its value, weight n, blocked weight b, and both by fold of the host."""
    each = labelled.select(F.explode(F.map_from_arrays(F.array(F.lit("suffix"), F.lit("segment")), F.array("suffix", "segment"))).alias("what", "value"), "label", "weight", _fold().alias("fold"))
    counted = each.groupBy("what", "value", "fold").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("b"))
    folds = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "b"))))  # FOLDS entries at most
    return stored(counted.groupBy("what", "value").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), folds.alias("folds")), "rates")


def with_rates(rows: DataFrame, known: DataFrame, out_of_fold: bool = False) -> DataFrame:
    """Adds suffix_rate and segment_rate; for rows to learn from, without the labels of their own host's fold, their own among them."""
    for what in ("suffix", "segment"):
        own = F.col("folds")[_fold()] if out_of_fold else F.lit(None).cast("struct<n:double,b:double>")
        less = lambda c: F.col(c) - F.coalesce(own[c], F.lit(0.0))  # noqa: E731, B023
        counts = known.filter(F.col("what") == what).select(F.col("value").alias(what), "n", "b", "folds")
        rate = ((less("b") + PRIOR / 2) / (less("n") + PRIOR)).alias(f"{what}_rate")
        rows = rows.join(counts, what, "left").select(*rows.columns, rate)
    return rows.fillna({"suffix_rate": 0.5, "segment_rate": 0.5})


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict, and the trees' probability ``blocked`` (null where a rule decides)."""
    kept = [c for c in pages.columns if c not in MADE]
    host, path = split_url(F.col("url"))
    # Kept columns travel in a struct, so that they may have any names.
    parsed = pages.select("url", F.struct(*kept).alias("_kept"), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    shown = [*[F.col("_kept")[c].alias(c) for c in kept], *PARTS, F.col("found.rule").alias("rule")]

    own = pages.select("url", host.alias("host"), path.alias("path"))
    own = own.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules)).filter(F.col("found").isNotNull())
    each = own.groupBy("url", "host", "path", (F.col("found.verdict") == BLOCK).cast("double").alias("label")).agg(F.count(F.lit(1)).alias("copies"))
    labelled = stored(lexical(each), "labelled-urls")
    totals = {r["label"]: r for r in labelled.groupBy("label").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("urls")).collect()}
    by_rule = parsed.filter(F.col("found").isNotNull()).select(*shown, F.col("found.verdict").alias("verdict"), F.lit(None).cast("double").alias("blocked"))
    others = parsed.filter(F.col("found").isNull())
    if len(totals) < 2:
        only = BLOCK if 1.0 in totals else ALLOW
        return by_rule.unionByName(others.select(*shown, F.lit(only).alias("verdict"), F.lit(None).cast("double").alias("blocked")))

    n = sum(r["n"] for r in totals.values())
    weight = F.col("copies") * F.when(F.col("label") == 1, n / (2 * totals[1.0]["n"])).otherwise(n / (2 * totals[0.0]["n"]))  # both verdicts weigh the same
    labelled = labelled.withColumn("weight", weight)
    known = rates(labelled)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    # Each verdict has its own half of the sample, of distinct URLs, so a rare one is there and a frequent URL counts by its weight.
    halves = [
        spread_sample(labelled.filter(F.col("label") == label), F.col("url"), r["urls"], SAMPLE // 2).withColumn("weight", F.col("weight") * max(1.0, 2 * r["urls"] / SAMPLE))
        for label, r in sorted(totals.items())
    ]
    sample = stored(with_rates(halves[0].unionByName(halves[1]), known, out_of_fold=True).select(*FEATURES, "label", "weight"), "labelled")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=LEVELS, seed=1)
    model = trees.fit(vector.transform(sample))
    rows = lexical(others.select("url", *PARTS, F.struct(*shown).alias("_kept")))
    scored = model.transform(vector.transform(with_rates(rows, known)))
    share = vector_to_array("probability")[1]
    judged = scored.select("_kept.*", F.when(share >= 0.5, BLOCK).otherwise(ALLOW).alias("verdict"), share.alias("blocked"))
    return by_rule.unionByName(judged)


def op6(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", *PARTS, "rule", "verdict")
