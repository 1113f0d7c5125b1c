"""Which batches still need writing, and what an ingest did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_KEY = ["dt", "batch"]


def missing_batches(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidate rows/keys whose ``(dt, batch)`` is not stored yet.

    No broadcast hint: the stored-key list grows with the lake, so AQE picks a
    broadcast only when the runtime size is under the broadcast threshold.
    """
    keys = existing.select(F.col("dt").cast("date").alias("dt"), F.col("batch").cast("string").alias("batch"))
    return candidates.join(keys, BATCH_KEY, "left_anti")


def ingest_summary(candidate_keys: DataFrame, missing_keys: DataFrame, failed_keys: DataFrame | None = None) -> DataFrame:
    """``sent``, ``ignored`` (already stored), ``errors`` (batches whose write failed), ``total`` batches."""
    marked = missing_keys.select(*BATCH_KEY, F.lit(1).alias("_missing"))
    counts = candidate_keys.select(*BATCH_KEY).join(marked, BATCH_KEY, "left")
    failed = F.lit(0).cast("bigint")
    if failed_keys is not None:
        counts = counts.join(failed_keys.select(*BATCH_KEY, F.lit(1).alias("_failed")), BATCH_KEY, "left")
        failed = F.count("_failed")
    return counts.agg(F.count(F.lit(1)).alias("total"), F.count("_missing").alias("n_missing"), failed.alias("errors")).select(
        (F.col("n_missing") - F.col("errors")).alias("sent"), (F.col("total") - F.col("n_missing")).alias("ignored"), "errors", "total"
    )
