"""Exact deduplication (2): group by a 128-bit content hash, compare bytes
inside the groups, keep one row of each.

Texts are equal when they are identical after white space (space, tab to
carriage return) is deleted.  Of equal texts the row with the most code points
stays, then the smallest id, then one of the equal rows.

Two passes read the texts.  The first compares bytes: distinct (hash, text)
pairs are counted by hash, and a hash with more than one text is a collision.
The second reduces each document to a narrow row (id, length, hash, digest; the
text itself only for collided hashes) and counts rows that are equal in all of
them; groups and result come from those.  Copies are combined before each
shuffle, and the last join has the documents on its skewed side, where Spark
splits partitions.

Defined cases: null counts as the empty text, and all empty texts are one
group.  A null id comes after every other id.  Rows that repeat an id and text
are separate rows, of which one stays.  A very long text is hashed and compared
whole, like any other.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squeezed(text: Column) -> Column:
    """``text`` (null: empty) without white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.select("id", F.char_length("text").alias("chars"), squeezed(F.col("text")).alias("norm"))
    hashed = own.withColumn("hash", content_hash(F.encode("norm", "utf-8")))
    texts = hashed.select("hash", "norm").distinct()
    collided = texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("hash")
    if collided.isEmpty():
        rows = hashed.withColumn("variant", F.lit(""))
    else:
        rows = hashed.join(collided.withColumn("several", F.lit(True)), "hash", "left")
        rows = rows.withColumn("variant", F.when(F.col("several"), F.col("norm")).otherwise(""))
    rows = rows.select("id", "chars", "hash", "variant", F.sha2("norm", 256).alias("sha"))
    rows = rows.groupBy("id", "chars", "hash", "variant", "sha").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("chars")).alias("longest"), F.col("id").isNull().alias("none"), "id"))
    groups = rows.groupBy("hash", "variant").agg(F.sum("n").alias("group_size"), best.alias("best"))
    wins = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("chars") == -F.col("best.longest"))
    out = rows.join(groups, ["hash", "variant"]).withColumn("wins", wins)
    # equal rows come back from their number, a million at a time
    out = out.withColumn("from", F.explode(F.expr("sequence(1, n, 1000000)")))
    out = out.withColumn("copy", F.explode(F.expr("sequence(`from`, least(`from` + 999999, n))")))
    return out.select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("wins") & (F.col("copy") == 1)).alias("kept"), F.col("sha").alias("text_sha256"),
    )
