"""URL filter: host-suffix and path-prefix expressions joined to hashed rules.

Each URL is expanded into (host suffix, path prefix) expressions, joined to the
rules on the first 8 hex digits of the expression's SHA-256, and kept where the
whole digest agrees. Of the rules that fit, the longest wins; of equally long ones
the one with the longer host, and of two verdicts for one expression, ``block``.

Defined cases: a null url, or one without ``://``, has an empty host and path and
no rule; equal URLs are judged once and every row keeps its verdict; without rules
every verdict is the default; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import broadcast_if_small

_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY_DIGITS = 8
#: Rules up to this many are broadcast; more are joined by shuffle.
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, _URL, 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def hashed_rules(rules: DataFrame) -> DataFrame:
    """(host, path, action) as (expression, key, digest, verdict), one row for each expression."""
    text = F.concat(F.col("host"), F.col("path"))
    return (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("action").alias("rule_verdict"))  # 'block' > 'allow'
        .select(
            text.alias("rule"), F.length("host").alias("host_length"), "rule_verdict",
            F.length("path").alias("path_length"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.sha2(_expression(F.col("host"), F.col("path")), 256).alias("digest"),
        )
        .withColumn("hash_key", F.substring("digest", 1, KEY_DIGITS))
    )


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def filter_urls(
    pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict) for each row of ``pages``."""
    parts = pages.select(F.col(id), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    table = hashed_rules(rules)
    shape = table.agg(
        F.count("*").alias("rules"), F.max("labels").alias("labels"),
        F.collect_set("path_length").alias("lengths"),
    ).first()
    # No rule has more labels or another path length, so no other expression can fit one.
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape["labels"] or 1))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )
    lengths = F.array(*[F.lit(n) for n in sorted(shape["lengths"])]) if shape["lengths"] else F.array(F.lit(0))
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    expanded = (
        parts.select("host", "path").distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .withColumn("full", F.sha2(_expression(F.col("suffix"), F.col("prefix")), 256))
        .withColumn("hash_key", F.substring("full", 1, KEY_DIGITS))
    )
    order = F.struct(F.length("rule"), "host_length", "rule")
    best = (
        expanded.join(broadcast_if_small(table, shape["rules"], BROADCAST_RULES), "hash_key")
        .where(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "rule_verdict"), order).alias("best"))
    )
    return parts.join(best, ["host", "path"], "left").select(
        id, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
