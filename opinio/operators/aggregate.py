"""Trusted -> product: sentiment, key filter, grouped counts and means (D2 core)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.dates import iso
from opinio.functions.rules import sentiment
from opinio.schemas import PRODUCT_COLUMNS

GROUP_KEYS = ("age_band", "department_name", "sentiment")


def with_sentiment(df: DataFrame) -> DataFrame:
    """P5: derive ``sentiment`` from ``rating`` and ``recommended_ind``."""
    return df.withColumn("sentiment", sentiment("rating", "recommended_ind"))


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Rows with a band and a department only."""
    return df.where(F.col("age_band").isNotNull() & F.col("department_name").isNotNull())


def review_count() -> Column:
    """A2: rows per group as a 32-bit int (ANSI: overflow raises, never wraps)."""
    return F.count(F.lit(1)).cast("int").alias("review_count")


def avg_rating() -> Column:
    """A3: mean rating, HALF_UP to two decimals.

    The rating is read with Spark's own cast to double, as the job being
    matched does (not the Python rule the sentiment uses): ``try_cast`` is that
    cast without ANSI's failure, so unreadable ratings are skipped, while text
    such as ``1d``, `` 4 `` or ``nan`` reads as the cast reads it.
    """
    return F.round(F.avg(F.col("rating").try_cast("double")), 2).alias("avg_rating")


def product(trusted: DataFrame) -> DataFrame:
    """A1 (+P5, P3, P6): the data product.

    With a ``dt`` column the grouping runs for all days at once (``dt`` becomes
    a key), which equals running each day on its own because days are disjoint.
    Partial aggregation happens before the shuffle, so a hot key costs one row
    per map task, not one row per review.
    """
    keys = (["dt"] if "dt" in trusted.columns else []) + list(GROUP_KEYS)
    needed = [c for c in ("dt", "age_band", "department_name", "rating", "recommended_ind") if c in trusted.columns]
    grouped = drop_null_keys(with_sentiment(trusted.select(*needed))).groupBy(*keys)
    out = grouped.agg(review_count(), avg_rating())
    return out.select(*PRODUCT_COLUMNS, *(["dt"] if "dt" in keys else []))


def dt_equals(df: DataFrame, day: str | _dt.date) -> DataFrame:
    """One partition (pruned at the scan when ``dt`` is a folder key)."""
    return df.where(F.col("dt") == F.to_date(F.lit(iso(day))))


def dt_from(df: DataFrame, start_from: str | _dt.date | None) -> DataFrame:
    """Partitions on or after ``start_from``; no bound given -> all."""
    if not start_from:
        return df
    return df.where(F.col("dt") >= F.to_date(F.lit(iso(start_from))))
