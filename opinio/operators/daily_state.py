"""States that days replace, so that reports and views need not scan the product.

*Day states* for the quality checks: one small row per product day (rows, label sets,
null counts), stored under ``dt=`` and replaced with the day.  The checks merge them;
the result equals a scan of the whole table.

*View totals* for the saved views: exact sums and counts by a view's groups.  When
days are run again, what the old days had put in is taken out and the new days' part
added; since the sums are exact decimals and counts, the totals equal a recomputation
after any order of re-runs.  Cells that the exact type does not hold are counted
apart, and a group that has any takes its mean from the product, as the view does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.dates import iso
from opinio.operators.views import mean_of_means, total_reviews
from opinio.sources.files import day_path
from opinio.sources.sinks import write_days_parquet
from opinio.sources.storage import children

STATE_SCHEMA = "rows bigint, age_bands array<string>, sentiments array<string>, null_age_band bigint, null_sentiment bigint, dt date"


def day_states(product: DataFrame) -> DataFrame:
    """One row per day of the product; label sets are bounded by the rules' vocabularies."""
    return product.groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set("age_band")).alias("age_bands"), F.array_sort(F.collect_set("sentiment")).alias("sentiments"),
        F.count_if(F.col("age_band").isNull()).alias("null_age_band"), F.count_if(F.col("sentiment").isNull()).alias("null_sentiment"),
    )


def replace_states(product: DataFrame, state_root: str, days: Iterable) -> None:
    """The stored states of ``days``, made anew from their rows in ``product`` (none for a day without rows)."""
    days = [iso(d) for d in days]
    own = product.where(F.col("dt").isin([F.to_date(F.lit(d)) for d in days]))
    write_days_parquet(day_states(own), state_root, days, repartition_by_day=True)


def stored_states(spark: SparkSession, state_root: str) -> DataFrame:
    if not any(name.startswith("dt=") for name, _ in children(spark, state_root)):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(state_root)


def merged_stats(states: DataFrame) -> DataFrame:
    """The report's aggregates (one row, as ``quality.table_stats``) from day states alone."""
    labels = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    zero = F.lit(0).cast("bigint")
    return states.agg(
        F.count_distinct("dt").alias("n_dt"), labels("age_bands").alias("age_bands"), labels("sentiments").alias("sentiments"),
        F.coalesce(F.sum("null_age_band"), zero).alias("null_age_band"), F.coalesce(F.sum("null_sentiment"), zero).alias("null_sentiment"),
        F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"),
    )


TOTALS = ["reviews", "counted", "cents", "exact", "cells", "rows"]


def view_totals(product: DataFrame, keys: list[str]) -> DataFrame:
    """Exact parts of a view by its groups: reviews, cells with reviews, sum of the cell means,
    cells that it holds, cells with a mean, rows."""
    cents = F.col("avg_rating").try_cast("decimal(16,2)")
    none = F.lit(0).cast("decimal(38,2)")
    return product.groupBy(*keys).agg(
        F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("reviews"), F.count("review_count").alias("counted"), F.coalesce(F.sum(cents.cast("decimal(28,2)")), none).cast("decimal(38,2)").alias("cents"),
        F.count(cents).alias("exact"), F.count("avg_rating").alias("cells"), F.count(F.lit(1)).alias("rows"),
    )


def after_rerun(totals: DataFrame, old_days: DataFrame, new_days: DataFrame, keys: list[str]) -> DataFrame:
    """``totals`` once the product's ``old_days`` are replaced by ``new_days`` (product rows of the days run again)."""
    gone, come = view_totals(old_days, keys), view_totals(new_days, keys)
    signed = totals.unionByName(come).unionByName(gone.select(*keys, *[(-F.col(c)).cast(gone.schema[c].dataType).alias(c) for c in TOTALS]))
    sums = [F.sum(c).cast("decimal(38,2)" if c == "cents" else "bigint").alias(c) for c in TOTALS]
    return signed.groupBy(*keys).agg(*sums).where("rows > 0")


def view_of_totals(totals: DataFrame, product: DataFrame, keys: list[str]) -> DataFrame:
    """The saved view (total_reviews, media_nota) by ``keys``; only groups with a cell beyond the exact type read ``product``."""
    held = F.col("exact") == F.col("cells")
    mean = F.round(F.col("cents") / F.nullif(F.col("exact"), F.lit(0)).cast("decimal(12,0)"), 2).cast("double")
    out = totals.where(held).select(*keys, F.when(F.col("counted") > 0, F.col("reviews")).alias("total_reviews"), mean.alias("media_nota"))
    other = totals.where(~held).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rest = product.join(other, same, "left_semi").groupBy(*keys).agg(total_reviews(), mean_of_means())
    return out.union(rest).orderBy(*keys)


def product_days(spark: SparkSession, product_root: str, days: Iterable, schema) -> DataFrame:
    """The stored rows of ``days`` (those that there are); read before and after a re-run for ``after_rerun``."""
    there = {name for name, _ in children(spark, product_root)}
    paths = [day_path(product_root, d) for d in days if f"dt={iso(d)}" in there]
    return spark.read.schema(schema).option("basePath", product_root).parquet(*paths) if paths else spark.createDataFrame([], schema)
