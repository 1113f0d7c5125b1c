"""Many days as one distributed job, with a per-day status frame.

The reference runs one orchestrated execution per day, strictly in sequence.
Here all selected days are cleaned in one job and aggregated in one job
(``dt`` is a group key); a day is then SUCCEEDED when its product partition
has rows and FAILED with ``EmptyPartition`` otherwise.  A folder whose name
is not a ``YYYY-MM-DD`` date fails on its own before any job runs.  If the
multi-day job itself fails, the days are split in halves and retried, so a
bad day fails alone while the others still run as a few multi-day jobs.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.dates import InvalidDate, coalesce_text, elapsed_seconds, iso
from opinio.operators.aggregate import product
from opinio.operators.clean import clean
from opinio.operators.quality import EmptyPartition, partition_counts
from opinio.plans.daily import run_day
from opinio.plans.layout import Lake
from opinio.schemas import RUNLOG_SCHEMA
from opinio.sources.catalog import sync_partitions
from opinio.sources.files import list_partitions, product_scan, raw_scan, trusted_scan
from opinio.sources.sinks import append_journal, last_entries, write_days_parquet


@dataclass
class BackfillResult:
    days: list[str]
    log: DataFrame | None
    exit_code: int
    error: str | None = None


def select_days(spark: SparkSession, lake: Lake, start_from: str | None = None) -> DataFrame:
    """S8 -> P8 -> O5: raw days on or after ``start_from``, chronologically."""
    days = list_partitions(spark, lake.raw)
    if start_from:
        days = days.where(F.col("dt") >= F.lit(iso(start_from)))
    return days.orderBy("dt")


def _days_frame(spark: SparkSession, days: list[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "dt string")


def run_days(spark: SparkSession, lake: Lake, days: list[str], table: str | None = None) -> DataFrame:
    """Clean and aggregate ``days`` as two jobs; returns ``(dt, row_count)`` per day."""
    if not days:
        return spark.createDataFrame([], "dt date, row_count bigint")
    # Only the selected day folders are listed and read (no whole-lake listing).
    raw = raw_scan(spark, lake.raw, days=days)
    write_days_parquet(clean(raw), lake.trusted, days)
    trusted = trusted_scan(spark, lake.trusted, days=days)
    write_days_parquet(product(trusted), lake.product, days, repartition_by_day=True)
    wanted = F.col("dt").isin([F.to_date(F.lit(d)) for d in days])
    if table:
        sync_partitions(spark, table, days)
    prod = product_scan(spark, table or lake.product).where(wanted)
    return partition_counts(prod, _days_frame(spark, days))


def backfill(
    spark: SparkSession,
    lake: Lake,
    start_from: str | None = None,
    dry_run: bool = False,
    table: str | None = None,
    journal: str | None = None,
    wave: int = 400,
) -> BackfillResult:
    """List -> filter -> run all days -> status log + exit code.

    With ``journal``, a folder that belongs to this run, the days are run in
    waves of ``wave`` days, and each wave's log rows are appended there as it
    ends.  A run that was killed is continued with the same folder: days that it
    holds as succeeded are not run again, and the log has every day's last row.

    Exit code 0 when every day succeeded (or nothing was listed), 1 when a day
    failed, 2 when the raw layer could not be listed.  ``dry_run`` only
    lists.  The day list is bounded by the number of partitions, so it is
    held on the driver.
    """
    try:
        days = [r["dt"] for r in select_days(spark, lake, start_from).collect()]
    except Exception as exc:  # the raw layer could not be listed: nothing ran
        return BackfillResult([], None, 2, f"{type(exc).__name__}: {exc}")
    if dry_run or not days:
        return BackfillResult(days, None, 0)
    if journal is None:
        records = run_and_log(spark, lake, days, table)
    else:
        done = {r[0]: r for r in last_entries(spark, journal)}
        left = [d for d in days if d not in done or done[d][1] != "SUCCEEDED"]
        for k in range(0, len(left), wave):
            rows = run_and_log(spark, lake, left[k : k + wave], table)
            append_journal(spark, rows, journal)
            done |= {r[0]: r for r in rows}
        records = [done[d] for d in days]
    log = spark.createDataFrame(records, RUNLOG_SCHEMA)
    failed = sum(1 for r in records if r[1] != "SUCCEEDED")
    return BackfillResult(days, log, 1 if failed else 0)


def run_and_log(spark: SparkSession, lake: Lake, days: list[str], table: str | None = None) -> list[tuple]:
    """Run ``days`` and return their run-log rows ``(dt, status, duration_s, error)``.

    Folder names that are not dates fail alone; the rest run as multi-day
    jobs, bisected around failures (see ``_run_group``).
    """
    records = [_invalid_day(d) for d in days if not _is_day(d)]
    valid = [d for d in days if _is_day(d)]
    if valid:
        records += _run_group(spark, lake, valid, table)
    return sorted(records, key=lambda r: r[0])


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _is_day(name: str) -> bool:
    """A ``dt=`` folder name in canonical ``YYYY-MM-DD`` form."""
    try:
        return iso(name) == name
    except InvalidDate:
        return False


def _invalid_day(name: str) -> tuple:
    return (name, "FAILED", 0.0, f"InvalidDate | folder dt={name} is not a YYYY-MM-DD date")


def _run_group(spark: SparkSession, lake: Lake, days: list[str], table: str | None) -> list[tuple]:
    """Log rows for ``days``, run as one multi-day job.

    If the job fails, the group is split in halves and each half retried the
    same way, so the good days still run in about ``2 * log2(days)`` jobs; a
    single failing day is run on its own for its typed error.  Re-running
    days is safe: every write is a whole-day overwrite.
    """
    started = _now()
    try:
        counts = run_days(spark, lake, days, table)
        # The log records this run: its rows are fixed now, not re-derived
        # later from a product that later runs may change.
        return [tuple(r) for r in status_log(counts, started, _now(), len(days)).collect()]
    except Exception:
        if len(days) == 1:
            return [_single_day(spark, lake, days[0], table)]
        mid = len(days) // 2
        return _run_group(spark, lake, days[:mid], table) + _run_group(spark, lake, days[mid:], table)


def _single_day(spark: SparkSession, lake: Lake, day: str, table: str | None) -> tuple:
    t0 = time.monotonic()
    try:
        run_day(spark, lake, day, table)
        status, error = "SUCCEEDED", ""
    except EmptyPartition as exc:
        status, error = "FAILED", f"EmptyPartition | {exc}"
    except Exception as exc:
        status, error = "FAILED", f"{type(exc).__name__} | {exc}"
    return (day, status, max(0.0, time.monotonic() - t0), error)


def status_log(counts: DataFrame, started: _dt.datetime, stopped: _dt.datetime, n_days: int) -> DataFrame:
    """Run log rows ``dt, status, duration_s, error`` from per-day product counts.

    A day with rows SUCCEEDED; a day without rows FAILED with ``EmptyPartition``.
    The days ran as one job, so each carries an equal share of its elapsed time.
    """
    ok = F.col("row_count") > 0
    dt_text = F.col("dt").cast("string")
    share = elapsed_seconds(F.lit(started), F.lit(stopped)) / F.lit(max(n_days, 1))
    error = F.when(
        ok, F.lit("")
    ).otherwise(coalesce_text(F.lit("EmptyPartition"), F.concat(F.lit("no product rows for dt="), dt_text)))
    return counts.select(
        dt_text.alias("dt"),
        F.when(ok, F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("status"),
        share.alias("duration_s"),
        error.alias("error"),
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Successes, failures, total, elapsed seconds (the sum of the days' unrounded shares), exit code."""
    ok = F.count_if(F.col("status") == "SUCCEEDED")
    bad = F.count_if(F.col("status") != "SUCCEEDED")
    return log.agg(
        ok.alias("successes"),
        bad.alias("failures"),
        F.count(F.lit(1)).alias("total"),
        F.round(F.sum("duration_s"), 1).alias("duration_s"),
        F.when(bad > 0, F.lit(1)).otherwise(F.lit(0)).alias("exit_code"),
    )
