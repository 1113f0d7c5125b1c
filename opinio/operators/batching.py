"""Global row numbering and daily batch assignment without a one-task sort.

Two orders are supported.

*Key order* (``with_row_index``): Spark's range partitioner cuts the rows by all
order columns and, last, by arrival, so rows that tie in every order column
still spread over the ranges.  Each range is sorted by its own task; a row's
index is its place in the range plus the rows of the ranges before it (one
count per range).  The placed rows are persisted, because the counts and the
rows must come from the same cut.

*File order* (``with_file_index``): a file split's rows already stand in order
within the task that read them, so no row moves: index = rows of the splits
before + position in the task - the split's first position there.
"""

from __future__ import annotations

import datetime as _dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.dates import batch_name, ceil_div, date_add_days
from opinio.schemas import DEFAULT_BATCH_SIZE, DEFAULT_START_DATE

_RANGE, _PLACE, _ARRIVAL = "_opinio_range", "_opinio_place", "_opinio_arrival"
_IN_TASK = (1 << 33) - 1  # low bits of monotonically_increasing_id: the row's place in its task


def _columns(order_cols: str | list[str]) -> list[str]:
    return [order_cols] if isinstance(order_cols, str) else list(order_cols)


def placed_rows(df: DataFrame, order_cols: str | list[str], num_ranges: int | None = None) -> DataFrame:
    """``df`` cut into sorted ranges, with ``_RANGE`` and ``_PLACE`` (0-based, in the range).

    ``num_ranges`` defaults to the shuffle width of the session."""
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_columns(order_cols), _ARRIVAL]
    cut = df.withColumn(_ARRIVAL, F.monotonically_increasing_id()).repartitionByRange(max(1, n), *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK))
    return cut.sortWithinPartitions(*order).withColumn(_RANGE, F.spark_partition_id()).withColumn(_PLACE, place).drop(_ARRIVAL)


def with_row_index(
    df: DataFrame, order_cols: str | list[str], index_col: str = "row_index", num_ranges: int | None = None
) -> DataFrame:
    """Append a 0-based dense global row index following ``order_cols`` (ascending, nulls first)."""
    rows = placed_rows(df, order_cols, num_ranges).persist(StorageLevel.DISK_ONLY)
    counts = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # one row per range: as many as the caller (or the shuffle width) asked for
    return rows.join(F.broadcast(offsets), _RANGE).withColumn(index_col, F.col("_offset") + F.col(_PLACE)).drop(_RANGE, _PLACE, "_offset")


def with_batches(indexed: DataFrame, batch_size: int, start_date: str | _dt.date, index_col: str = "row_index") -> DataFrame:
    """Row i -> ``batch_index = i // size``, ``dt = start + batch_index``, ``batch = batch_{index+1:03d}``."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    idx = F.floor(F.col(index_col) / F.lit(batch_size)).cast("bigint")
    return (
        indexed.withColumn("batch_index", idx)
        .withColumn("dt", date_add_days(start_date, F.col("batch_index")))
        .withColumn("batch", batch_name(F.col("batch_index")))
    )


def assign_batches(
    df: DataFrame,
    order_cols: str | list[str],
    batch_size: int = DEFAULT_BATCH_SIZE,
    start_date: str | _dt.date = DEFAULT_START_DATE,
    num_ranges: int | None = None,
) -> DataFrame:
    """W1 in key order."""
    return with_batches(with_row_index(df, order_cols, "row_index", num_ranges), batch_size, start_date)


def batch_keys(
    spark, n_rows: int, batch_size: int, start_date: str | _dt.date, with_index: bool = False
) -> DataFrame:
    """All ``(dt, batch)`` keys for ``n_rows`` rows, without touching the rows.

    ``with_index`` adds the 0-based ``batch_index``.
    """
    one = spark.range(1).select(ceil_div(F.lit(n_rows), batch_size).alias("n"))
    idx = F.col("id")
    cols = [date_add_days(start_date, idx).alias("dt"), batch_name(idx).alias("batch")]
    if with_index:
        cols.append(idx.alias("batch_index"))
    return spark.range(one.first()["n"]).select(*cols)


def batch_summary(batches: DataFrame, order_col: str) -> DataFrame:
    """Per batch: day, name, rows, first and last key."""
    return (
        batches.groupBy("dt", "batch", "batch_index")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(order_col).alias("first_key"),
            F.max(order_col).alias("last_key"),
        )
        .orderBy("batch_index")
    )


# Columns of ``with_file_position``: file name, split start, position in the task.
FILE_POSITION_COLS = ("_file_name", "_file_block", "_file_pos")


def with_file_position(df: DataFrame) -> DataFrame:
    """Add ``FILE_POSITION_COLS`` to a file-source frame (must sit on the scan).

    * ``_file_name``: the source file (``input_file_name``);
    * ``_file_block``: start offset of the file split the row was read from
      (``input_file_block_start``; 0 when a file is one split, as with
      ``multiLine`` CSV);
    * ``_file_pos``: position inside the read task, which grows along the rows
      of a split and is the same when the task is retried.
    """
    name, block, pos = FILE_POSITION_COLS
    return (
        df.withColumn(name, F.input_file_name())
        .withColumn(block, F.input_file_block_start())
        .withColumn(pos, F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)))
    )


def with_file_index(positioned: DataFrame, index_col: str = "row_index") -> DataFrame:
    """``FILE_POSITION_COLS`` -> a 0-based dense index by file name and place in the file.

    The running sum sees one row per file split (some 128 MB of input each).
    The splits are counted once and persisted, so that Spark knows their size
    when it chooses the join; a broadcast, where it fits, leaves the rows in place.
    """
    name, block, pos = FILE_POSITION_COLS
    before = Window.orderBy(name, block).rowsBetween(Window.unboundedPreceding, -1)
    splits = positioned.groupBy(name, block).agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_first"))
    offsets = splits.select(name, block, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    offsets = offsets.persist(StorageLevel.DISK_ONLY)
    offsets.count()
    return positioned.join(offsets, [name, block]).withColumn(index_col, F.col("_shift") + F.col(pos)).drop(*FILE_POSITION_COLS, "_shift")
