"""URL rules by host suffix and path prefix, in DataFrame functions only.

Every distinct (host, path) is expanded into the host suffixes and path prefixes that a rule could
have; each expression is looked up by the first four bytes of its SHA-256, and a hit counts once the
whole digest agrees. The longest rule wins; of rules of one length the one with the longer host,
then a block, wins. Without a rule the verdict is the default.

Expansion follows the rules: only suffixes of as many labels and prefixes of as many characters as some
rule has, so its size does not grow with the length of a URL.

Defined results: NULL or a URL without ``://`` has empty host and path; an empty path starts with no
rule's path that holds a ``/``; repeated pages keep their rows; no pages or no rules give no rows or
no hits. Host case folds A-Z only; port and user info are part of the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    """``action, host, path`` from a list of rules."""
    columns = "action string, host string, path string"
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("action", "host", "path")])
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a), F.lit(h), F.lit(p)) for a, h, p in rules]))).toDF(*[c.split()[0] for c in columns.split(", ")])


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def expansions(keys: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """``host, path`` to one row per candidate expression."""
    parts = F.split("host", r"\.", -1)
    suffixes = F.array_compact(F.array(*[
        F.when(F.size("_parts") >= n, F.array_join(F.slice("_parts", -n, n), ".")) for n in labels
    ]))
    prefixes = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]))
    return (
        keys.withColumn("_parts", parts)
        .select("host", "path", F.explode(suffixes).alias("_h"), prefixes.alias("_p"))
        .select("host", "path", "_h", F.explode("_p").alias("_p"))
        .withColumn("_digest", _digest(F.concat("_h", "_p")))
    )


def matched_rules(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, action`` for the distinct keys that a rule fits."""
    shape = rules.agg(
        F.collect_set(F.size(F.split("host", r"\.", -1))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")
    ).first()  # a few integers: no host has more than 127 labels, no path more than a URL's length
    if not shape["labels"]:
        return keys.select("host", "path", F.lit("").alias("rule"), F.lit("").alias("action")).where(F.lit(False))
    named = rules.select(
        "action", F.concat("host", "path").alias("rule"), F.length("host").alias("_hlen"),
        _digest(F.concat("host", "path")).alias("_full"),
    ).withColumn("_short", F.substring("_full", 1, PREFIX_HEX))
    found = expansions(keys, sorted(shape["labels"]), sorted(shape["lengths"])).withColumn(
        "_short", F.substring("_digest", 1, PREFIX_HEX)
    )
    hits = found.join(named, "_short").where(F.col("_digest") == F.col("_full"))
    rank = F.struct(F.length("rule"), F.col("_hlen"), (F.col("action") == "block").cast("int"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), rank).alias("b"))
    return best.select("host", "path", "b.rule", "b.action")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = matched_rules(rows.select("host", "path").distinct(), rules)
    return rows.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict")
    )
