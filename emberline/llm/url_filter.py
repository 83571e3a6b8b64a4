"""URL filter by Bloom filter cascades, with built-in functions only.

A rule is a key, host and path prefix put together. Of each url all keys that could be listed are derived (host
suffixes with as many labels as a listed key has at most, path prefixes as long as a listed path); the cascades
are built over all these keys of the whole table, so that every answer about them is exact without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.bloom import Cascade, SplitCascade, build_cascade

#: Fixed values of the result contract: (action, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))

#: Hosts with one of these terms are listed where no rule fits.
TERMS = ("adult", "betting", "casino", "pills", "porn", "viagra", "xxx")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for NULL and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, path_lengths: list[int]) -> Column:
    """Every key that could be listed for this url: suffixes of at most ``labels`` labels, each with path prefixes."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), n - labels + 1), n),
                           lambda i: F.array_join(F.slice(parts, i, n), "."))
    prefixes = [F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in path_lengths]
    keys = F.flatten(F.transform(suffixes, lambda s: F.array(*[F.concat(s, p) for p in prefixes])))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.filter(keys, lambda k: k.isNotNull()))


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Hosts of the table with one of TERMS in their name."""
    host, _ = host_and_path(F.col("url"))
    return pages.select(host.alias("key")).filter(F.col("key").rlike("|".join(TERMS)))


def longest(keys: Column) -> Column:
    """NULL for no key."""
    return F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))["k"]


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES,
                hosts: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages`` (page_id, url).

    The longest rule that fits decides (of two actions for one key, block); else ``hosts`` (column ``key``, by
    default listed_hosts) blocks a listed host and its subdomains, and everything else is allowed. A NULL url,
    one without ``://`` or with an empty host fits nothing and is allowed. NULL ids and repeated rows are judged
    like any row, an empty table gives an empty result, other columns are ignored. Very long urls are judged whole: they
    have as many keys as others, as both labels and path prefixes are bounded by the listed keys.
    """
    spark = pages.sparkSession
    hosts = listed_hosts(pages) if hosts is None else hosts
    blocked = spark.createDataFrame([(h + p,) for a, h, p in rules if a == "block"], "key string")
    allowed = spark.createDataFrame([(h + p,) for a, h, p in rules if a == "allow"], "key string")
    most = hosts.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first().n or 1
    labels = max([most, *(h.count(".") + 1 for _, h, _ in rules)])
    lengths = sorted({0, *(len(p) for _, _, p in rules)})
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = judged.select(F.explode("keys").alias("key"))
    block, allow, spam = (build_cascade(listed, universe, "key") for listed in (blocked, allowed, hosts))

    def matched(cascade: Cascade | SplitCascade) -> Column:
        return longest(F.filter("keys", cascade.contains))

    judged = judged.select("page_id", "host", "path", matched(block).alias("blocked"), matched(allow).alias("allowed"),
                           F.exists("keys", spam.contains).alias("listed"))
    by_block = F.col("blocked").isNotNull() & (
        F.col("allowed").isNull() | (F.length("blocked") >= F.length("allowed")))
    rule = F.when(by_block, F.col("blocked")).otherwise(F.col("allowed"))
    verdict = (F.when(by_block, "block").when(F.col("allowed").isNotNull(), "allow")
               .when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
