"""Writers with overwrite semantics.

Two write shapes:

* leaf: one day's folder ``root/dt=YYYY-MM-DD`` overwritten as a whole, even
  with zero rows (the emptied day then really is empty);
* multi-day: ``partitionBy("dt")`` with dynamic partition overwrite, so only the
  written days are replaced.  Dynamic overwrite leaves a day untouched when
  the new data has no rows for it; the days actually written are observed
  during the same write (no extra scan), and every requested day that got no
  rows is then leaf-overwritten with an empty frame.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opinio.functions.dates import iso
from opinio.schemas import RUNLOG_SCHEMA
from opinio.sources.files import CSV_WRITE_OPTIONS, STORED_BATCHES, day_path
from opinio.sources.storage import file_system


class PartitionColumnInFile(ValueError):
    """A leaf write would store ``dt`` inside the file as well as in the path."""


def _guard_leaf(df: DataFrame) -> None:
    if "dt" in df.columns:
        raise PartitionColumnInFile("drop 'dt' before a leaf write; the folder carries it")


def write_leaf_parquet(df: DataFrame, root: str, day: str | _dt.date) -> str:
    """Overwrite one day with snappy Parquet (idempotent)."""
    _guard_leaf(df)
    path = day_path(root, day)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def strip_partition_column(df: DataFrame) -> DataFrame:
    """P10: drop ``dt`` before a leaf write."""
    return df.drop("dt")


def write_days_parquet(
    df: DataFrame,
    root: str,
    days: Iterable[str | _dt.date],
    repartition_by_day: bool = False,
) -> list[str]:
    """Multi-day overwrite of exactly ``days``; returns the days left empty.

    ``df`` must have a ``dt`` column and only rows of ``days``.  With
    ``repartition_by_day`` the rows are first gathered per day (one file per
    day), which suits small outputs such as the product.
    """
    wanted = sorted({iso(d) for d in days})
    if not wanted:
        return []
    obs = Observation("opinio_days_written")
    data = df.repartition("dt") if repartition_by_day else df
    observed = data.observe(obs, F.collect_set(F.col("dt").cast("string")).alias("days"))
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("dt")
        .parquet(root)
    )
    written = set(obs.get.get("days") or [])
    emptied = [d for d in wanted if d not in written]
    if emptied:
        # one empty leaf is written; the other emptied days get copies of its files
        first = write_leaf_parquet(strip_partition_column(df).limit(0), root, emptied[0])
        _copy_leaf(df.sparkSession, first, [day_path(root, d) for d in emptied[1:]])
    return emptied


def _copy_leaf(spark, source: str, targets: list[str]) -> None:
    fs, leaf = file_system(spark, source)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def copy(target: str) -> None:
        place = jvm.org.apache.hadoop.fs.Path(target)
        fs.delete(place, True)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, leaf, fs, place, False, conf)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(copy, targets))


def write_raw_days_csv(df: DataFrame, root: str, mode: str = "overwrite", by: tuple[str, ...] = ("dt",)) -> None:
    """S7 (folder form): raw CSV partitioned by ``dt`` (and ``batch``)."""
    writer = df.write.mode(mode).options(**CSV_WRITE_OPTIONS)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).csv(root)


def move_batches(spark: SparkSession, keys: Iterable[tuple[int, str, str]], source: str, root: str) -> list[tuple[int, str]]:
    """The batch folders ``(number, dt, batch)`` of ``source`` take their places under ``root``, in the stead
    of what is there (torn batches); returns the numbers of those that could not, with the error."""
    store, _ = file_system(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def move(key: tuple[int, str, str]) -> tuple[int, str] | None:
        number, day, batch = key
        try:
            folder = path(day_path(root, day))
            place = path(folder, f"batch={batch}")
            store.delete(place, True)
            store.mkdirs(folder)
            if store.rename(path(f"{day_path(source, day)}/batch={batch}"), place):
                return None
            raise OSError(f"{place} can't be made")
        except Exception as exc:  # this batch's alone
            return number, f"{type(exc).__name__}: {exc}"

    with ThreadPoolExecutor(8) as pool:
        return [failed for failed in pool.map(move, keys) if failed]


def record_batches(keys: DataFrame, root: str) -> None:
    """Completion records ``(dt, batch)`` of batches that a finished job has written."""
    keys.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{STORED_BATCHES}")


def write_leaf_csv(df: DataFrame, root: str, day: str | _dt.date) -> str:
    """Overwrite one raw day with CSV (used to replace a day's reviews)."""
    _guard_leaf(df)
    path = day_path(root, day)
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def _typed(kind: str, text: str | None):
    """A check's expected/actual text as the report's typed JSON value."""
    if text is None:
        return None
    if kind == "scalar":
        return int(text)
    if kind == "set":
        return [v for v in text.split(",") if v]
    low, _, high = text.partition("..")
    return {"min": low or None, "max": high or None}


def write_report(checks: DataFrame, summary: DataFrame, path: str, target: str) -> dict:
    """One JSON document: generated_at, database, table, checks, summary.

    Each check carries ``id, name, status, expected, actual, sql, detail``;
    expected/actual are typed (a count, a sorted label list, or a
    ``{min, max}`` date range).  The check frame has one row per check (six),
    so it is gathered whole; the document is written as a single-line JSON
    file.
    """
    from opinio.operators.quality import CHECK_KINDS, check_sql

    database, _, table = target.rpartition(".")
    rows = []
    for r in checks.orderBy("check_id").collect():
        cid, kind = r["check_id"], CHECK_KINDS[r["check_id"]]
        rows.append(
            {
                "id": cid,
                "name": r["name"],
                "status": r["status"],
                "expected": _typed(kind, r["expected"]),
                "actual": _typed(kind, r["actual"]),
                "sql": check_sql(cid, target),
                "detail": r["detail"],
            }
        )
    summ = summary.first().asDict()
    doc = {
        "generated_at": _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0).isoformat().replace("+00:00", "Z"),
        "database": database or None,
        "table": table,
        "checks": rows,
        "summary": {"pass": summ["pass_count"], "fail": summ["fail_count"], "overall": summ["overall"]},
    }
    spark = checks.sparkSession
    text = json.dumps(doc, ensure_ascii=False, separators=(",", ":"))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return doc


def write_runlog(log: DataFrame, path: str) -> None:
    """Run log CSV ``dt,status,duration_s,error`` (rewritten per run; seconds to one decimal)."""
    log.select("dt", "status", F.round("duration_s", 1).alias("duration_s"), "error").coalesce(1).write.mode("overwrite").options(
        **CSV_WRITE_OPTIONS
    ).csv(path)


def append_journal(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Run-log rows of days that have just ended, added to the run's journal by one committed write."""
    entry = F.struct(F.current_timestamp().alias("written"), F.monotonically_increasing_id().alias("place"))
    spark.createDataFrame(rows, RUNLOG_SCHEMA).coalesce(1).withColumn("entry", entry).write.mode("append").parquet(path)


def last_entries(spark: SparkSession, path: str) -> list[tuple]:
    """Each day's last row of a journal (as many rows as days); none where there is no journal yet."""
    fs, place = file_system(spark, path)
    if not fs.exists(place):
        return []
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in RUNLOG_SCHEMA.fields)}, entry struct<written:timestamp,place:bigint>"
    kept = spark.read.schema(schema).parquet(path).groupBy("dt").agg(F.max_by(F.struct(*RUNLOG_SCHEMA.names), "entry").alias("r"))
    return [tuple(r) for r in kept.select("r.*").collect()]
