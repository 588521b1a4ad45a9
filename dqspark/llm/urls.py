"""URL filters: host suffixes and path prefixes against rules, by hash prefix and then whole digest."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from dqspark.llm.common import Rows

#: Hexadecimal digits of a digest on which URLs and rules are joined.
SHORT = 8


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    """Neither part can hold the sign between them."""
    return F.sha2(F.concat(host, F.lit("?"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict (``block`` or ``allow``). A rule fits its host and all subdomains, if the
    URL's path starts with the rule's. Of those that fit the longest (host and path together) wins, then the
    longer host, then ``block``. Without any, ``rule`` is null and the verdict is ``default``.

    Each distinct host and path is expanded once: into its last n labels for every n that a rule has, times its
    first m signs for every m that a rule's path has. These expressions meet the rules on the first digits
    of a digest; the whole digest then confirms. What is collected are the numbers n and m alone, which no
    number of pages or rules can make many. A host or URL that many pages share is one row before any join.

    Null URLs, and those without ``://``, have an empty host and path. Null parts of a rule count as empty, and
    a rule without a host fits no URL. Repeated pages come out alike; input columns with the names of the
    added ones are replaced.
    """
    rows = Rows(pages)
    frame = rows.frame.withColumns({"host": host_of(F.col(rows.of[url])), "path": path_of(F.col(rows.of[url]))})
    parts = rules.select(
        F.coalesce("host", F.lit("")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict"
    ).filter("rule_host != '' AND verdict IS NOT NULL")
    sizes = parts.agg(
        F.collect_set(F.size(F.split("rule_host", "\\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("signs"),
    ).first()
    if not sizes["labels"]:
        judged = frame.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
        return rows.back(judged, "host", "path", "rule", "verdict")
    confirmed = _digest(F.col("rule_host"), F.col("rule_path"))
    listed = parts.withColumn("rule_digest", confirmed).withColumn("short", F.substring("rule_digest", 1, SHORT))
    best = _expressions(frame, sizes["labels"], sizes["signs"]).join(listed, "short").filter("digest = rule_digest")
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    best = best.groupBy("host", "path").agg(F.max(order).alias("best"))
    # Joined as one struct, Spark shuffles for the join and does not reuse the grouping: a hot URL can then be split.
    best = best.select(F.struct("host", "path").alias("of"), "best")
    judged = frame.join(best, F.struct("host", "path").eqNullSafe(F.col("of")), "left").withColumns(
        {"rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))}
    )
    return rows.back(judged, "host", "path", "rule", "verdict")


def _expressions(frame: DataFrame, labels: list[int], signs: list[int]) -> DataFrame:
    """Each distinct host and path with the digests of its suffixes and prefixes."""
    counts = F.array(*[F.lit(n) for n in sorted(labels)])
    lengths = F.array(*[F.lit(n) for n in sorted(signs)])
    return (
        frame.select("host", "path")
        .filter("host != ''")
        .distinct()
        .withColumn("n", F.explode(F.filter(counts, lambda n: n <= F.size(F.split("host", "\\.")))))
        .withColumn("m", F.explode(F.filter(lengths, lambda m: m <= F.length("path"))))
        .withColumn("labels", F.split("host", "\\."))
        .withColumn("suffix", F.array_join(F.expr("slice(labels, -n, n)"), "."))
        .withColumn("digest", _digest(F.col("suffix"), F.expr("substring(path, 1, m)")))
        .select("host", "path", "digest", F.substring("digest", 1, SHORT).alias("short"))
    )
