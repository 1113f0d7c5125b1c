"""Late rows without re-running their day.

``process_new_days`` reads a day's raw files again whenever one more of them lands.
Here only the landed files are read: their rows become cells (day, band, department,
sentiment) with the number of reviews, of rated ones and an exact sum of the ratings,
and a day's product follows from the sum of its cells over all deliveries.

Sums are kept in 64ths, as integers, so they do not depend on the order in which files
land; the mean is then what the batch job computes.  A rating that this does not hold
(not a multiple of 1/64, 2^20 and more, NaN) makes its day ``odd``: such a day is run
as a whole by the batch job, as before.

State: ``state/dt=<day>/epoch=<n>/base=0`` holds the cells that micro-batch n added.  A
replayed micro-batch overwrites its own folders, so nothing counts twice.  After
``fold_after`` deliveries a day's cells are added up in ``base=1`` of the last epoch,
which stands for all up to it and appears by one rename; readers start at the last such
folder.  A raw file that is rewritten in place is no late row (the file stream does
not report it again): ``rebuild_days`` makes the state of its day anew.

The trusted layer is not written; a run of the day's batch job does that.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.dates import iso
from opinio.operators.aggregate import GROUP_KEYS, drop_null_keys, with_sentiment
from opinio.operators.clean import clean
from opinio.operators.quality import partition_counts
from opinio.plans.backfill import _invalid_day, _is_day, _now, run_days, status_log
from opinio.plans.layout import Lake
from opinio.schemas import PRODUCT_TABLE_SCHEMA, RUNLOG_SCHEMA
from opinio.sources.catalog import sync_partitions
from opinio.sources.files import day_path, product_scan, raw_scan
from opinio.sources.sinks import write_days_parquet
from opinio.sources.storage import children
from opinio.streaming.incremental import landed_files

_PARTS = ("reviews", "rated", "sum64", "odd")
CELL_SCHEMA = "age_band string, department_name string, sentiment string, reviews bigint, rated bigint, sum64 bigint, odd bigint, dt date, epoch bigint, base int"


def cells(trusted: DataFrame) -> DataFrame:
    """The product's groups with their exact parts; the work is the batch product's: partial sums, one shuffle."""
    rating = F.col("rating").try_cast("double")
    held = (F.abs(rating) < float(1 << 20)) & (F.rint(rating * 64) == rating * 64)
    rows = drop_null_keys(with_sentiment(trusted.select("dt", "age_band", "department_name", "rating", "recommended_ind")))
    return rows.groupBy("dt", *GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("reviews"), F.count(rating).alias("rated"),
        F.coalesce(F.sum(F.when(held, (rating * 64).try_cast("bigint"))), F.lit(0)).cast("bigint").alias("sum64"), F.count_if(~held).alias("odd"),
    )


def day_cells(spark: SparkSession, state: str, days: list[str]) -> DataFrame:
    """The cells of ``days`` over all deliveries; only these days' folders are listed and read."""
    there = {name for name, _ in children(spark, state)}
    paths = [day_path(state, d) for d in days if f"dt={iso(d)}" in there]
    rows = spark.read.schema(CELL_SCHEMA).option("basePath", state).parquet(*paths) if paths else spark.createDataFrame([], CELL_SCHEMA)
    last = rows.where("base = 1").groupBy("dt").agg(F.max("epoch").alias("last"))
    counts = F.col("last").isNull() | F.when(F.col("base") == 1, F.col("epoch") == F.col("last")).otherwise(F.col("epoch") > F.col("last"))
    added = rows.join(last, "dt", "left").where(counts).groupBy("dt", *GROUP_KEYS)
    return added.agg(*[F.sum(c).alias(c) for c in _PARTS])


def product_of_cells(found: DataFrame) -> DataFrame:
    """The product rows of cells that are not odd."""
    mean = F.round(F.col("sum64").cast("double") / 64 / F.nullif(F.col("rated"), F.lit(0)), 2)
    out = found.where("reviews > 0").select("dt", *GROUP_KEYS, F.col("reviews").cast("int").alias("review_count"), mean.alias("avg_rating"))
    return out.select(*PRODUCT_TABLE_SCHEMA.names)


def _write(found: DataFrame, state: str, epoch: int, base: int) -> None:
    out = found.withColumn("epoch", F.lit(epoch)).withColumn("base", F.lit(base)).repartition("dt")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "epoch", "base").parquet(state)


def _epochs(spark: SparkSession, state: str, day: str) -> list[int]:
    return [int(m[1]) for name, _ in children(spark, day_path(state, day)) if (m := re.fullmatch(r"epoch=([0-9]+)", name))]


def _write_base(spark: SparkSession, found: DataFrame, state: str, epoch: int, days: list[str]) -> None:
    """Cells that stand for everything of ``days`` up to ``epoch``; a day without cells has one of no reviews."""
    empty = spark.createDataFrame([(_dt.date.fromisoformat(d),) for d in days], "dt date").select("dt", *[F.lit(None).cast("string").alias(k) for k in GROUP_KEYS], *[F.lit(0).cast("bigint").alias(c) for c in _PARTS])
    _write(found.unionByName(empty), state, epoch, 1)


def apply_files(spark: SparkSession, lake: Lake, state: str, paths: list[str], epoch: int, table: str | None = None, fold_after: int = 32) -> list[tuple]:
    """Adds the rows of landed raw files to their days; the run-log rows of these days.  Repeating an epoch with
    the same files changes nothing."""
    of_path = {p: m[1] for p in paths if (m := re.search(r"/dt=([^/]+)/", p))}
    days = sorted({d for d in of_path.values() if _is_day(d)})
    log = [_invalid_day(d) for d in sorted(set(of_path.values()) - set(days))]
    if not days:
        return log
    started = _now()
    _write(cells(clean(raw_scan(spark, lake.raw, files=[p for p, d in of_path.items() if _is_day(d)]))), state, epoch, 0)
    log += [tuple(r) for r in status_log(_publish(spark, lake, state, days, table), started, _now(), len(days)).collect()]
    often = [d for d in days if len(_epochs(spark, state, d)) >= fold_after]
    if often:
        _write_base(spark, day_cells(spark, state, often), state, epoch, often)
    return sorted(log, key=lambda r: r[0])


def _publish(spark: SparkSession, lake: Lake, state: str, days: list[str], table: str | None) -> DataFrame:
    """Writes the product of ``days`` from their cells; (dt, row_count) of each."""
    found = day_cells(spark, state, days)
    odd = {r[0].isoformat() for r in found.where("odd > 0").select("dt").distinct().collect()}  # among these days
    plain = [d for d in days if d not in odd]
    wanted = lambda some: F.col("dt").isin([F.to_date(F.lit(d)) for d in some])
    write_days_parquet(product_of_cells(found.where(wanted(plain))), lake.product, plain, repartition_by_day=True)
    if odd:
        run_days(spark, lake, sorted(odd))
    if table:
        sync_partitions(spark, table, days)
    return partition_counts(product_scan(spark, table or lake.product).where(wanted(days)), spark.createDataFrame([(d,) for d in days], "dt string"))


def rebuild_days(spark: SparkSession, lake: Lake, state: str, days: list[str], table: str | None = None) -> None:
    """State and product of ``days`` made anew from all their raw files (between two runs of the stream)."""
    days = sorted({iso(d) for d in days})
    last = {d: max(_epochs(spark, state, d), default=0) for d in days}
    found = cells(clean(raw_scan(spark, lake.raw, days=days)))
    for epoch in sorted(set(last.values())):
        some = [d for d in days if last[d] == epoch]
        _write_base(spark, found.where(F.col("dt").isin([F.to_date(F.lit(d)) for d in some])), state, epoch, some)
    _publish(spark, lake, state, days, table)


def process_late_rows(spark: SparkSession, lake: Lake, state: str, checkpoint: str, table: str | None = None, available_now: bool = True, max_files: int = 10_000, run_log: str | None = None):
    """Starts the stream; returns the ``StreamingQuery``.  ``state`` and ``checkpoint`` belong together: the stream
    begins with the files that are there.  A micro-batch takes at most ``max_files`` files (their paths come to the
    driver); its log rows go to ``run_log/epoch=N``."""
    log_root = (run_log or f"{checkpoint.rstrip('/')}_runlog").rstrip("/")

    def handle(batch: DataFrame, epoch: int) -> None:
        paths = sorted(r.path for r in batch.select("path").collect())
        rows = apply_files(spark, lake, state, paths, epoch, table) if paths else []
        if rows:
            spark.createDataFrame(rows, RUNLOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{log_root}/epoch={epoch}")

    writer = landed_files(spark, lake, max_files).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
