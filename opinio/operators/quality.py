"""Whole-table quality checks in one scan.

The six checks of the report read the same table; here they are one
aggregation (count-distinct, two label sets, two null counts, min, max)
unpivoted into one row per check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.dates import date_prefix, iso
from opinio.schemas import AGE_BANDS, EXPECTED_MIN_DT, EXPECTED_PARTITIONS, SENTIMENTS

CHECK_COLUMNS = ("check_id", "name", "status", "expected", "actual", "detail")

# Check ids and names, in report order.
CHECK_NAMES = (
    (1, "COUNT DISTINCT dt"),
    (2, "DISTINCT age_band"),
    (3, "DISTINCT sentiment"),
    (4, "age_band IS NULL"),
    (5, "sentiment IS NULL"),
    (6, "MIN/MAX dt"),
)


# The aggregates that each check takes from the product table, in report order.
CHECK_STATS = {
    1: {"n_dt": "count(DISTINCT dt)"},
    2: {"age_bands": "array_sort(collect_set(age_band))"},
    3: {"sentiments": "array_sort(collect_set(sentiment))"},
    4: {"null_age_band": "count_if(age_band IS NULL)"},
    5: {"null_sentiment": "count_if(sentiment IS NULL)"},
    6: {"min_dt": "min(dt)", "max_dt": "max(dt)"},
}


def check_sql(check_id: int, table: str) -> str:
    """The statement of one check (together they run as one aggregation)."""
    return f"SELECT {', '.join(CHECK_STATS[check_id].values())} FROM {table}"


# How each check's expected/actual text reads as a typed value.
CHECK_KINDS = {1: "scalar", 2: "set", 3: "set", 4: "scalar", 5: "scalar", 6: "range"}


class EmptyPartition(RuntimeError):
    """The gate found zero product rows for a day."""


def _lit_or_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _date_expr(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.to_date(F.lit(iso(value)))


def _label_set(values) -> Column:
    return F.array_sort(F.array(*[F.lit(v) for v in values]))


def _set_text(arr: Column) -> Column:
    return F.array_join(F.array_sort(arr), ",")


def _list_repr(arr: Column) -> Column:
    """A label list as Python prints it: ``['Adulto', 'Jovem']``."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def table_stats(product: DataFrame, only: tuple[int, ...] = tuple(CHECK_STATS)) -> DataFrame:
    """A7-A12 in one aggregation; returns one row.

    The label sets are bounded by the label vocabularies of the rules.
    """
    return product.agg(*[F.expr(sql).alias(name) for cid in only for name, sql in CHECK_STATS[cid].items()])


def set_equal(actual: Column, expected: Column) -> Column:
    """Same elements, order and duplicates ignored."""
    return (F.size(F.array_except(actual, expected)) == 0) & (
        F.size(F.array_except(expected, actual)) == 0
    )


def quality_checks(
    product: DataFrame | None,
    expected_partitions: int | Column = EXPECTED_PARTITIONS,
    expected_min_dt: str | _dt.date | Column = EXPECTED_MIN_DT,
    expected_max_dt: str | _dt.date | Column | None = None,
    expected_age_bands=AGE_BANDS,
    expected_sentiments=SENTIMENTS,
    only: tuple[int, ...] = tuple(CHECK_STATS),
    error: Column | None = None,
    spark: SparkSession | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """D6 core: check rows ``(check_id, name, status, expected, actual, detail)``.

    ``expected_max_dt`` defaults to ``expected_min_dt + expected_partitions - 1``.
    Expectations may be literals or scalar Columns (e.g. scalar subqueries).
    ``only`` names the checks to run.  Without a product (``spark`` then gives
    the session) the checks fail with ``error`` as detail and keep their expectation.
    ``stats`` (one row, as of ``table_stats``) takes the place of a scan of the product.
    """
    n_exp = _lit_or_col(expected_partitions).cast("bigint")
    min_exp = _date_expr(expected_min_dt)
    max_exp = (
        _date_expr(expected_max_dt)
        if expected_max_dt is not None
        else F.date_add(min_exp, (n_exp - 1).cast("int"))
    )
    bands_exp = _label_set(expected_age_bands)
    sents_exp = _label_set(expected_sentiments)
    expected = {
        1: n_exp.cast("string"), 2: _set_text(bands_exp), 3: _set_text(sents_exp), 4: F.lit("0"), 5: F.lit("0"),
        6: F.concat_ws("..", min_exp.cast("string"), max_exp.cast("string")),
    }
    found: dict[int, tuple[Column, Column, Column]] = {}
    if product is not None or stats is not None:
        count = lambda c: F.concat(F.lit("count="), F.col(c).cast("string"))
        values = lambda c: F.concat(F.lit("values="), _list_repr(F.col(c)))
        low, high = date_prefix(F.col("min_dt")), date_prefix(F.col("max_dt"))
        in_range = (F.col("min_dt") == min_exp) & (F.col("max_dt") == max_exp)
        shown = F.concat(F.lit("min="), F.coalesce(low, F.lit("None")), F.lit(" max="), F.coalesce(high, F.lit("None")))
        found = {
            1: (F.col("n_dt") == n_exp, F.col("n_dt").cast("string"), count("n_dt")),
            2: (set_equal(F.col("age_bands"), bands_exp), _set_text(F.col("age_bands")), values("age_bands")),
            3: (set_equal(F.col("sentiments"), sents_exp), _set_text(F.col("sentiments")), values("sentiments")),
            4: (F.col("null_age_band") == 0, F.col("null_age_band").cast("string"), count("null_age_band")),
            5: (F.col("null_sentiment") == 0, F.col("null_sentiment").cast("string"), count("null_sentiment")),
            6: (in_range, F.concat_ws("..", low, high), shown),
        }
    structs = []
    for cid, name in CHECK_NAMES:
        if cid in only:
            ok, actual, detail = found.get(cid, (F.lit(False), F.lit(None).cast("string"), error))
            status = F.when(F.coalesce(ok, F.lit(False)), F.lit("PASS")).otherwise(F.lit("FAIL"))
            structs.append(
                F.struct(
                    F.lit(cid).alias("check_id"), F.lit(name).alias("name"), status.alias("status"),
                    expected[cid].alias("expected"), actual.alias("actual"), detail.alias("detail"),
                )
            )
    if stats is None:
        stats = table_stats(product, only) if product is not None else spark.range(1)
    return stats.select(F.inline(F.array(*structs))).select(*CHECK_COLUMNS)


def quality_summary(checks: DataFrame) -> DataFrame:
    """Pass count, fail count and overall verdict of a check frame."""
    passed = F.count_if(F.col("status") == "PASS")
    failed = F.count_if(F.col("status") != "PASS")
    return checks.agg(
        passed.alias("pass_count"),
        failed.alias("fail_count"),
        F.when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("overall"),
    )


def null_rows(product: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is null."""
    return product.where(F.col(column).isNull())


def distinct_sorted(product: DataFrame, column: str) -> DataFrame:
    """A8/A9 + O4: the distinct non-null values of a label column, sorted."""
    return product.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def partition_counts(product: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """A13 for many days at once: ``(dt, row_count)``.

    With ``days`` (a frame with a ``dt`` column) every listed day appears,
    with 0 when the product has no rows for it.
    """
    counts = product.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))
    if days is None:
        return counts
    return (
        days.select(F.col("dt").cast("date").alias("dt"))
        .distinct()
        .join(counts, "dt", "left")
        .select("dt", F.coalesce(F.col("row_count"), F.lit(0)).alias("row_count"))
    )


def partition_row_count(product: DataFrame, day: str | _dt.date) -> int:
    """A13 gate for one day: its row count, raising ``EmptyPartition`` on 0."""
    n = product.where(F.col("dt") == F.to_date(F.lit(iso(day)))).count()
    if n == 0:
        raise EmptyPartition(f"no product rows for dt={iso(day)}")
    return n


def table_count(product: DataFrame) -> DataFrame:
    """Rows in the product."""
    return product.agg(F.count(F.lit(1)).alias("row_count"))
