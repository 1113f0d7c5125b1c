"""Slice a source into daily batches and store the ones not stored yet.

One Spark job replaces the per-batch loop: the batch keys follow from the row
count, those already stored are taken out, and only then are rows numbered (W1)
and the missing batches written as CSV beside the days, then moved to
``dt=YYYY-MM-DD/batch=batch_NNN/`` one by one.  A batch counts as stored once its
completion record is written, which happens after the job; a torn batch has
none and is overwritten by the next run.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.operators.batching import batch_keys, with_batches, with_file_index, with_row_index
from opinio.operators.ingest import BATCH_KEY, ingest_summary, missing_batches
from opinio.schemas import DEFAULT_BATCH_SIZE, DEFAULT_START_DATE
from opinio.sources.files import list_batches, source_scan
from opinio.sources.sinks import move_batches, record_batches, write_raw_days_csv
from opinio.sources.storage import checkpoint_root, file_system, scratch_path


@dataclass
class IngestResult:
    """``failed``: the batches whose write failed (dt, batch, error); None where all were stored."""

    summary: DataFrame
    exit_code: int
    error: str | None = None
    failed: DataFrame | None = None


def plan_ingest(
    spark: SparkSession,
    source: DataFrame,
    raw_root: str,
    number_rows: Callable[[DataFrame], DataFrame],
    start_date: str | _dt.date = DEFAULT_START_DATE,
    batch_size: int = DEFAULT_BATCH_SIZE,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Candidate keys, missing keys, and the rows still to write (None: no batch is missing)."""
    candidates = batch_keys(spark, source.count(), batch_size, start_date, with_index=True)
    # Listed and joined once, before the write below changes what is stored.
    checkpoint_root(spark)
    missing = missing_batches(candidates, list_batches(spark, raw_root)).checkpoint()
    n_missing = missing.count()
    if not n_missing:
        return candidates, missing, None
    rows = with_batches(number_rows(source), batch_size, start_date)
    if n_missing < candidates.count():
        rows = rows.join(missing.select("batch_index"), "batch_index", "left_semi")
    return candidates, missing, rows


def ingest(
    spark: SparkSession,
    source: DataFrame,
    raw_root: str,
    order_cols: str | list[str],
    start_date: str | _dt.date = DEFAULT_START_DATE,
    batch_size: int = DEFAULT_BATCH_SIZE,
) -> IngestResult:
    """D4 in key order: write the missing batches; summary ``sent, ignored, errors, total``.

    A re-run writes nothing.  A batch whose write fails counts as an error, the
    others are stored; the exit code is then 1, and a re-run writes that batch.
    """
    return _store(spark, source, raw_root, lambda rows: with_row_index(rows, order_cols), start_date, batch_size)


#: Batches that may fail alone; groups that fail after that many count as failed whole.
FAILURES = 32


def _store(spark, source, raw_root, number_rows, start_date, batch_size) -> IngestResult:
    candidates, missing, rows = plan_ingest(spark, source, raw_root, number_rows, start_date, batch_size)
    errors = []
    if rows is not None:
        span = missing.agg(F.min("batch_index"), F.max("batch_index")).first()
        errors = _write_batches(rows, missing, raw_root, span[0], span[1], FAILURES)
    if not errors:
        return IngestResult(ingest_summary(candidates, missing), 0)
    # a group of failed batches is a range of their numbers
    ranges = F.broadcast(spark.createDataFrame(errors, "first bigint, last bigint, error string"))
    failed = missing.join(ranges, F.col("batch_index").between(F.col("first"), F.col("last"))).select(*BATCH_KEY, "error")
    return IngestResult(ingest_summary(candidates, missing, failed), 1, errors[0][2], failed)


def _write_batches(rows: DataFrame, missing: DataFrame, raw_root: str, first: int, last: int, failures: int) -> list[tuple[int, int, str]]:
    """Writes the missing batches numbered first to last; returns ranges of failed ones with the error.

    They are written by one job into a folder beside the days and moved to their places, where a
    batch whose place can't be made fails alone; the moved ones get their completion records.  If
    the job fails, each half is written by a job of its own, so a batch that can't be written fails
    alone while the others take about two jobs for each halving."""
    own = lambda df: df.where(F.col("batch_index").between(first, last))
    if last < first or (first < last and own(missing).isEmpty()):
        return []
    spark, beside = rows.sparkSession, f"{raw_root.rstrip('/')}/_beside-{uuid.uuid4().hex[:12]}"
    try:
        write_raw_days_csv(own(rows).drop("row_index", "batch_index"), beside, "errorifexists", by=tuple(BATCH_KEY))
        keys = own(missing).select("batch_index", F.col("dt").cast("string"), "batch").collect()  # one a folder
        errors = move_batches(spark, sorted(map(tuple, keys)), beside, raw_root)
        stored = own(missing)
        if errors:
            stored = stored.join(spark.createDataFrame([(k,) for k, _ in errors], "batch_index bigint"), "batch_index", "left_anti")
        record_batches(stored.select(*BATCH_KEY), raw_root)
        return [(k, k, error) for k, error in errors]
    except Exception as exc:  # reported with its whole text, and by the exit code
        if first == last or failures <= 0:
            return [(first, last, f"{type(exc).__name__}: {exc}")]
    finally:
        store, place = file_system(spark, beside)
        store.delete(place, True)
    middle = (first + last) // 2
    failed = _write_batches(rows, missing, raw_root, first, middle, failures)
    return failed + _write_batches(rows, missing, raw_root, middle + 1, last, failures - len(failed))


def ingest_csv(
    spark: SparkSession,
    csv_path: str,
    raw_root: str,
    start_date: str | _dt.date = DEFAULT_START_DATE,
    batch_size: int = DEFAULT_BATCH_SIZE,
    multi_line: bool = True,
) -> IngestResult:
    """D4 from a CSV source in file order; exit code 2 when the source is missing.

    The records and their file positions are staged in the shared checkpoint folder,
    so that a row's position is fixed in storage, not recomputed on a retry.

    ``multi_line=True`` (default) reads quoted fields that span lines, large files
    by many tasks.  ``multi_line=False`` parses the lines where they are read and
    stages the rows; no line breaks inside fields are allowed then.
    """
    try:
        source = source_scan(spark, csv_path, multi_line)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            empty = spark.createDataFrame([], "sent bigint, ignored bigint, errors bigint, total bigint")
            return IngestResult(empty, 2, str(exc))
        raise
    if not multi_line:
        staged_path = scratch_path(spark, "ingest-staged") + "/source"
        source.write.mode("overwrite").parquet(staged_path)
        source = spark.read.parquet(staged_path)
    return _store(spark, source, raw_root, with_file_index, start_date, batch_size)
