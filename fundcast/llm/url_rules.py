"""URL filtering by hand-written rules and by mined association rules.

Spark FP-growth mines token combinations of labelled URLs together with their
label; rules "tokens -> bad" are pruned by support, confidence and improvement
over their own subsets, and matched through an inverted index: a rule is filed
under its rarest token, URLs look their tokens up there, and the rest of the
antecedent is checked on the URL's own token array.

Edge cases: a null URL, or one without ``://``, has empty host and path, no
tokens and is allowed; repeated rows are judged alike; unlabelled rows, null
labels and an empty label table simply mine nothing (all URLs are then allowed
unless a hand-written rule fits); ties between hand-written rules of equal
length go to the smaller rule string; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundcast.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"
#: Mining parameters: share of labelled URLs a rule must cover, its precision,
#: and how much it must beat each of its own sub-rules.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_IMPROVEMENT = 0.005, 0.6, 0.05


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Distinct tokens: host labels (h:), path words (p:), query keys (q:);
    numbers are one token per place, so that page numbers do not scatter."""

    def parts(text: Column, tag: str) -> Column:
        words = F.array_remove(F.split(lower_ascii(text), r"[^\p{L}\p{N}_\-]+"), "")
        return F.transform(words, lambda w: F.concat(F.lit(tag), F.regexp_replace(w, r"^\p{N}+$", "#")))

    query = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^?#]*\?([^#]*)", 1), "=[^&]*", "")
    return F.array_distinct(
        F.concat(parts(host_of(url), "h:"), parts(path_of(url), "p:"), parts(query, "q:"))
    )


def written_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Longest fitting rule of a hand-written list of (verdict, host, path) as
    struct(length, rule, verdict), null if none fits. The list is a parameter
    that a person maintains, so testing it per row is cheap."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    listed = F.array(
        *[
            F.when(
                ((host == h) | host.endswith("." + h)) & path.startswith(p),
                F.struct(F.lit(-len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
            )
            for v, h, p in rules
        ]
    )
    return F.array_min(listed)  # nulls are skipped; longest first, then rule string


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    min_improvement: float = MIN_IMPROVEMENT,
) -> DataFrame:
    """Rules (rule_id, tokens, anchor, confidence, support) from ``labelled``
    (url, bad boolean). Every labelled URL is a transaction; the result has at
    most as many rules as there are frequent token sets."""
    spark = labelled.sparkSession
    baskets = labelled.where(F.col("bad").isNotNull()).select(
        F.concat(
            url_tokens(F.col("url")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
        ).alias("items")
    ).where(F.size("items") > 0)
    baskets = cut_lineage(baskets, "url-baskets")
    # only token sets that are frequent together with the label can make a rule, and
    # such sets hold only tokens that are frequent among the bad URLs themselves
    bad_tokens = (
        baskets.where(F.array_contains("items", BAD)).select(F.explode("items").alias("token"))
        .groupBy("token").agg(F.count("*").alias("n"))
    )
    n_all = baskets.count()
    least = max(math.ceil(n_all * min_support), 2)
    frequent = bad_tokens.where(F.col("n") >= least).select("token")
    keep = (
        baskets.withColumn("basket", F.monotonically_increasing_id())
        .select("basket", F.explode("items").alias("token"))
        .join(frequent, "token").groupBy("basket").agg(F.collect_set("token").alias("items"))
    )
    keep = cut_lineage(keep, "url-frequent")
    empty = spark.createDataFrame(
        [], T.StructType.fromDDL("rule_id long, tokens array<string>, anchor string, confidence double, support double")
    )
    if keep.isEmpty():
        return empty
    # FPGrowth divides by the rows it sees; rows without frequent tokens were left out
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, least / keep.count()), minConfidence=min_confidence
    ).fit(keep)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence"
    )
    rules = cut_lineage(rules, "url-rules")
    # drop a rule if one of its sub-rules is about as precise: sub-rules share a token,
    # so they are found through the index of rules by token
    one = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    two = rules.select(F.col("tokens").alias("sub"), F.col("confidence").alias("sub_confidence"))
    two = two.withColumn("token", F.element_at("sub", 1))
    implied = one.join(two, "token").where(
        (F.size("sub") < F.size("tokens")) & (F.size(F.array_except("sub", "tokens")) == 0)
        & (F.col("sub_confidence") + min_improvement > F.col("confidence"))
    ).select("tokens").distinct()
    rules = rules.join(implied, "tokens", "left_anti")
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (
        rules.select("tokens", F.explode("tokens").alias("token")).join(counts, "token")
        .groupBy("tokens").agg(F.min(F.struct("freq", "token"))["token"].alias("anchor"))
    )
    return cut_lineage(
        rules.join(rarest, "tokens").select(
            F.xxhash64("tokens").alias("rule_id"), "tokens", "anchor", "confidence", F.lit(min_support).alias("support")
        ),
        "url-index",
    )


def matches(urls: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, n_rules, confidence) of the URLs that at least one rule matches.
    Only tokens that anchor a rule produce rows, and only once per rule."""
    anchors = rules.select(F.col("anchor").alias("token"), "rule_id", "tokens", "confidence")
    return (
        urls.select(key, url_tokens(F.col("url")).alias("own"))
        .select(key, "own", F.explode("own").alias("token"))
        .join(anchors, "token")
        .where(F.size(F.array_except("tokens", "own")) == 0)
        .groupBy(key)
        .agg(F.count("*").alias("n_rules"), F.max("confidence").alias("confidence"))
    )


def judge(
    pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = (), **mining
) -> DataFrame:
    """page_id, host, path, rule, verdict, n_rules, confidence for every row of
    ``pages`` (page_id, url)."""
    mined = mine(labelled, **mining)
    # rules judge urls, so rows with the same or no page_id never judge each other
    hit = matches(pages.select("url").distinct(), mined, "url").withColumnRenamed("url", "_url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    return (
        pages.select("page_id", "url", host.alias("host"), path.alias("path"))
        .withColumn("_w", written_rule(F.col("host"), F.col("path"), rules))
        .join(hit, F.col("url") == F.col("_url"), "left")
        .select(
            "page_id", "host", "path", F.col("_w")["rule"].alias("rule"),
            F.coalesce(F.col("_w")["verdict"], F.when(F.col("n_rules") > 0, "block").otherwise("allow")).alias("verdict"),
            F.coalesce("n_rules", F.lit(0)).alias("n_rules"), "confidence",
        )
    )
