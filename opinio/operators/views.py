"""The three saved summary queries over the product.

The views average the per-cell means without weights, as the saved queries
do.  The cell means are two-decimal values, so they are summed as
``decimal(16,2)``: the sum is exact, the division keeps fourteen decimals, and
the final HALF_UP rounding cannot be flipped by summation order.  A group with a
cell that this type does not hold takes the plain mean of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_reviews() -> Column:
    return F.sum("review_count").cast("bigint").alias("total_reviews")


def mean_of_means() -> Column:
    """``ROUND(AVG(avg_rating), 2)`` computed exactly over two-decimal cents.

    A group whose cells do not all fit the exact type (1e14 and more, and the
    NaN and infinities that ratings can read as) takes the plain double average.
    """
    x = F.col("avg_rating")
    cents = x.try_cast("decimal(16,2)")
    exact = F.round(F.sum(cents) / F.nullif(F.count(cents), F.lit(0)).cast("decimal(12,0)"), 2).cast("double")
    return F.when(F.count(cents) == F.count(x), exact).otherwise(F.round(F.avg(x), 2)).alias("media_nota")


def vw_sentiment_by_age(product: DataFrame) -> DataFrame:
    """A4 + O1: by band and sentiment, ordered by both."""
    return (
        product.groupBy("age_band", "sentiment")
        .agg(total_reviews(), mean_of_means())
        .orderBy("age_band", "sentiment")
    )


def vw_sentiment_by_dept(product: DataFrame) -> DataFrame:
    """A5 + O2: by department and sentiment; sentiment added to the order for determinism."""
    return (
        product.groupBy("department_name", "sentiment")
        .agg(total_reviews(), mean_of_means())
        .orderBy("department_name", "sentiment")
    )


def vw_daily_trend(product: DataFrame) -> DataFrame:
    """A6 + O3: reviews per day and sentiment."""
    return product.groupBy("dt", "sentiment").agg(total_reviews()).orderBy("dt", "sentiment")
