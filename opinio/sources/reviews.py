"""Review rows derived from the driver's test tables (no reviews table exists).

Each adapter returns raw-shaped reviews: the raw header names, every value a
string, plus the ``dt`` day.  The junk patterns (unreadable, exponent,
underscore and full-width numbers, fractional and out-of-range ratings, other
recommendations, blank texts, missing and empty departments) exercise the cleaning rules on every row of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _raw_columns(rid: Column, age_base: Column, text: Column, rating_src: Column, dept: Column, day: Column):
    base = (F.lit(10) + age_base % 60).cast("string")
    age = (
        F.when(rid % 97 == 0, F.lit("abc"))
        .when(rid % 89 == 0, F.lit(None).cast("string"))
        .when(rid % 7 == 0, F.concat(base, F.lit(".9")))
        .when(rid % 71 == 0, F.lit("4.5e1"))
        .when(rid % 61 == 0, F.lit("3_0"))
        .when(rid % 59 == 0, F.lit("\uff12\uff15"))
        .otherwise(base)
    )
    review_text = (
        F.when(rid % 10 == 0, F.lit("")).when(rid % 10 == 5, F.lit("   ")).otherwise(text)
    )
    stars = (F.lit(1) + F.floor(rating_src).cast("int") % 5).cast("string")
    rating = (
        F.when(rid % 43 == 0, F.lit("?"))
        .when(rid % 41 == 0, F.lit("4.5"))
        .when(rid % 37 == 0, F.lit("0"))
        .when(rid % 31 == 0, F.lit("3e0"))
        .otherwise(stars)
    )
    recommended = (
        F.when(rid % 47 == 0, F.lit("yes")).when(rid % 29 == 0, F.lit("1.0")).when(rid % 23 == 0, F.lit("2"))
        .when(rid % 3 == 0, F.lit("0")).otherwise(F.lit("1"))
    )
    department = F.when(rid % 53 == 0, F.lit(None).cast("string")).when(rid % 67 == 0, F.lit("")).otherwise(dept)
    return [
        rid.cast("string").alias("Clothing ID"),
        age.alias("Age"),
        review_text.alias("Review Text"),
        rating.alias("Rating"),
        recommended.alias("Recommended IND"),
        department.alias("Department Name"),
        day.cast("date").alias("dt"),
    ]


def reviews_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> reviews: one review per event, ``dt`` = event day."""
    return events.select(
        *_raw_columns(
            F.col("event_id"),
            F.col("user_id"),
            F.col("props"),
            F.col("value"),
            F.col("event_type"),
            F.col("ts"),
        )
    )


def reviews_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` -> reviews (larger input): ``dt`` = ship day.

    Review id ``orderkey * 8 + linenumber``; department = return flag + line
    status; rating from the quantity; a constant non-blank text.
    """
    rid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return lineitem.select(
        *_raw_columns(
            rid,
            F.col("l_partkey"),
            F.lit("lineitem review"),
            F.col("l_quantity"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
            F.col("l_shipdate"),
        )
    )
