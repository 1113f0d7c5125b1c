"""URL filter (7): host-suffix and path-prefix expressions of each URL against
hashed rules.

Each URL is expanded into the expressions (host suffix at a label boundary +
path prefix) whose shape (number of labels, length of path) some rule has; the
expressions meet the rules in an equi-join on the first four bytes of their
SHA-256, the full digest and the strings confirm a match, and the longest rule
wins.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and meets no rule but one with both empty.  Of rules of equal length that fit,
the one with the longer host wins, then block before allow, then the smaller
host and path; repeated rules count once.  An empty rule table lets the default
verdict stand for every URL.  A very long URL is matched whole.  Repeated rows stay repeated.
Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: the id, host, path, rule (or null) and verdict.

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``).
    """
    known = (
        rules.select("host", "path", "verdict")
        .where("host is not null and path is not null and verdict is not null")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("digest", F.sha2(F.concat("host", "path"), 256))
    )
    shapes = known.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars")).distinct().collect()
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    own = own.select(F.monotonically_increasing_id().alias("row"), "id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))

    def expression(labels: int, chars: int) -> Column:
        fits = (_labels(F.col("host")) >= labels) & (F.length("path") >= chars)
        text = F.concat(F.substring_index("host", ".", -labels), F.substring(F.col("path"), 1, chars))
        return F.when(fits, text)

    texts = F.array_compact(F.array(*[expression(s.labels, s.chars) for s in shapes])) if shapes else F.array().cast("array<string>")
    spread = own.withColumn("expression", F.explode_outer(texts)).withColumn("sha", F.sha2("expression", 256))
    met = spread.withColumn("short", F.substring("sha", 1, 8)).join(
        known.select(
            F.substring("digest", 1, 8).alias("short"), "digest", F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("rule_verdict"), F.length("host").alias("host_chars"),
        ),
        "short", "left",
    )
    sure = (F.col("sha") == F.col("digest")) & (F.col("expression") == F.col("rule"))
    order = F.struct(F.length("rule"), "host_chars", "rule_verdict", "rule")
    best = met.groupBy("row", "id", "host", "path").agg(F.max(F.when(sure, order)).alias("best"))
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
