"""New raw files -> the days they touch are re-run (D3/D5 as a stream).

The reference reacts to a new ``dt=`` folder by running the day's pipeline;
late or corrected files mean running that day again, whose overwrite keeps
it idempotent.  Here a file-source stream over the raw root does the
watching: each micro-batch names the days whose files arrived, and
``foreachBatch`` re-runs exactly those days as one multi-day job (whole days
are re-read from the raw layer, so a day delivered in several pieces is
always complete).  The stream itself lists file paths only (``binaryFile``
with the ``path`` column alone never opens a file), so landed rows are parsed
once, by the day job, not twice.  The stream's checkpoint records which files were seen, so
a restart neither loses nor repeats days.  ``availableNow`` processes what is
there and stops, like a scheduled run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.plans.backfill import run_and_log
from opinio.schemas import RUNLOG_SCHEMA
from opinio.plans.layout import Lake


# The fixed schema of the ``binaryFile`` source (streams must declare one).
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landed_files(spark: SparkSession, lake: Lake, max_files: int | None = None) -> DataFrame:
    """Stream of the paths of newly landed raw files (contents not read)."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(lake.raw).select("path")


def landed_days(spark: SparkSession, lake: Lake) -> DataFrame:
    """Stream of ``dt`` values, one per newly landed raw file (contents not read)."""
    day = F.regexp_extract(F.col("path"), r"/dt=([^/]+)/", 1)
    return landed_files(spark, lake).select(day.alias("dt")).where(F.col("dt") != "")


def process_new_days(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    table: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    run_log: str | None = None,
):
    """Start the stream; returns the ``StreamingQuery``.

    Each micro-batch runs its days like a backfill (a day that fails, or a
    folder that is not a date, fails alone and does not stall the stream) and
    writes its run log to ``run_log/epoch=N`` (default: next to the
    checkpoint).  A replayed micro-batch overwrites its own epoch, so the log
    stays exact.  With ``available_now`` the query stops by itself once every
    landed file has been handled; otherwise it polls every
    ``processing_time``.
    """
    log_root = (run_log or f"{checkpoint.rstrip('/')}_runlog").rstrip("/")

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # Bounded: the distinct days of one micro-batch.
        days = sorted(r["dt"] for r in batch.distinct().collect())
        if days:
            records = run_and_log(spark, lake, days, table)
            log = spark.createDataFrame(records, RUNLOG_SCHEMA)
            log.coalesce(1).write.mode("overwrite").parquet(f"{log_root}/epoch={epoch_id}")

    writer = landed_days(spark, lake).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
