"""One day through the pipeline."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from opinio.functions.dates import iso
from opinio.operators.aggregate import product
from opinio.operators.clean import clean
from opinio.operators.quality import partition_row_count
from opinio.plans.layout import Lake
from opinio.sources.files import product_scan, raw_scan, trusted_scan
from opinio.sources.sinks import write_leaf_parquet


class JobCleanFailed(RuntimeError):
    """The clean step of a day failed."""


class JobAggFailed(RuntimeError):
    """The aggregate step of a day failed."""


def clean_day(spark: SparkSession, lake: Lake, day: str | _dt.date) -> DataFrame:
    """Raw day -> trusted day (leaf overwrite, snappy Parquet)."""
    out = clean(raw_scan(spark, lake.raw, day))
    write_leaf_parquet(out, lake.trusted, day)
    return out


def aggregate_day(spark: SparkSession, lake: Lake, day: str | _dt.date) -> DataFrame:
    """Trusted day -> product day (leaf overwrite; ``dt`` only in the path)."""
    out = product(trusted_scan(spark, lake.trusted, day))
    write_leaf_parquet(out, lake.product, day)
    return out


def run_day(spark: SparkSession, lake: Lake, day: str | _dt.date, table: str | None = None) -> int:
    """D3: clean -> aggregate -> partition sync -> gate; returns the day's row count.

    Raises ``MissingPartition`` (no raw folder), ``JobCleanFailed``,
    ``JobAggFailed`` or ``EmptyPartition`` (zero product rows).
    """
    from opinio.sources.catalog import sync_partitions
    from opinio.sources.files import MissingPartition

    day = iso(day)
    try:
        clean_day(spark, lake, day)
    except MissingPartition:
        raise
    except Exception as exc:  # any failure of the step is that step's failure
        raise JobCleanFailed(f"clean failed for dt={day}: {exc}") from exc
    try:
        aggregate_day(spark, lake, day)
    except Exception as exc:
        raise JobAggFailed(f"aggregate failed for dt={day}: {exc}") from exc
    if table:
        sync_partitions(spark, table, [day])
    return partition_row_count(product_scan(spark, table or lake.product), day)
