"""Runs that fail in part or are killed: what is stored, what is reported, what a second run does."""

import os

import pytest
from pyspark.sql import functions as F

from opinio.plans import backfill as backfill_module
from opinio.plans import ingest as ingest_module
from opinio.plans.backfill import backfill
from opinio.plans.ingest import ingest
from opinio.plans.layout import Lake
from opinio.sources import files, publish
from opinio.sources.files import raw_scan
from opinio.sources.publish import PublishConflict, drop_run, manifest, publish_days, publish_run, published_scan, unpublished_runs, write_run
from opinio.sources.sinks import last_entries, write_raw_days_csv
from tests.conftest import edge_product, edge_reviews


def numbered(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") * 7).alias("v"))


def test_failing_batches_fail_alone_and_a_second_run_writes_them(spark, workdir):
    rows = numbered(spark, 95).withColumn("k", F.lpad("k", 4, "0"))
    bad = ["2024-01-03", "2024-01-08"]
    os.makedirs(workdir.removeprefix("file:"))
    for day in bad:
        open(f"{workdir}/dt={day}".removeprefix("file:"), "w").close()
    first = ingest(spark, rows, workdir, "k", batch_size=10)
    assert first.summary.first().asDict() == {"sent": 8, "ignored": 0, "errors": 2, "total": 10}
    assert first.exit_code == 1 and sorted((str(r.dt), r.batch) for r in first.failed.collect()) == [(bad[0], "batch_003"), (bad[1], "batch_008")]
    assert all(r.error for r in first.failed.collect())
    for day in bad:
        os.remove(f"{workdir}/dt={day}".removeprefix("file:"))
    second = ingest(spark, rows, workdir, "k", batch_size=10)
    assert second.summary.first().asDict() == {"sent": 2, "ignored": 8, "errors": 0, "total": 10}
    assert second.exit_code == 0 and second.failed is None
    got = sorted((r.k, r.batch) for r in raw_scan(spark, workdir).collect())
    assert got == [(f"{i:04d}", f"batch_{i // 10 + 1:03d}") for i in range(95)]


def test_no_job_for_each_batch_when_nothing_can_be_written(spark, workdir, monkeypatch):
    jobs = []

    def failing(*_, **__):
        jobs.append(1)
        raise OSError("no space left")

    monkeypatch.setattr(ingest_module, "write_raw_days_csv", failing)
    monkeypatch.setattr(ingest_module, "FAILURES", 3)
    res = ingest(spark, numbered(spark, 640), workdir, "v", batch_size=10)
    assert res.summary.first().asDict() == {"sent": 0, "ignored": 0, "errors": 64, "total": 64} and "no space left" in res.error
    assert len(jobs) < 30 and res.failed.count() == 64


def days_of(spark, days):
    return edge_reviews(spark).crossJoin(spark.createDataFrame([(d,) for d in days], "d string")).withColumn("dt", F.to_date("d")).drop("d")


def test_killed_backfill_goes_on_with_the_unfinished_days(spark, workdir, monkeypatch):
    days = [f"2024-01-0{k}" for k in range(1, 8)]
    lake, journal = Lake.under(workdir), f"{workdir}/journal"
    write_raw_days_csv(days_of(spark, days), lake.raw)
    real, ran = backfill_module.run_days, []

    def killed(s, the_lake, some, table=None):
        if len(ran) == 2:
            raise KeyboardInterrupt
        ran.append(list(some))
        return real(s, the_lake, some, table)

    monkeypatch.setattr(backfill_module, "run_days", killed)
    with pytest.raises(KeyboardInterrupt):
        backfill(spark, lake, journal=journal, wave=2)
    assert sorted(r[0] for r in last_entries(spark, journal)) == days[:4]
    ran.clear()
    monkeypatch.setattr(backfill_module, "run_days", lambda s, k, some, t=None: ran.append(list(some)) or real(s, k, some, t))
    res = backfill(spark, lake, journal=journal, wave=2)
    assert ran == [days[4:6], days[6:]] and res.exit_code == 0
    assert [(r.dt, r.status) for r in res.log.orderBy("dt").collect()] == [(d, "SUCCEEDED") for d in days]
    assert spark.read.parquet(lake.product).count() == len(days) * len(edge_product())
    ran.clear()
    assert backfill(spark, lake, journal=journal).exit_code == 0 and ran == []


def test_failed_days_of_a_journal_are_run_again(spark, workdir):
    lake, journal = Lake.under(workdir), f"{workdir}/journal"
    write_raw_days_csv(days_of(spark, ["2024-01-01"]), lake.raw)
    blank = days_of(spark, ["2024-01-02"]).withColumn("Review Text", F.lit(""))
    write_raw_days_csv(blank, lake.raw)
    assert backfill(spark, lake, journal=journal).exit_code == 1
    write_raw_days_csv(days_of(spark, ["2024-01-02"]), lake.raw)
    res = backfill(spark, lake, journal=journal)
    assert res.exit_code == 0 and {r[1] for r in last_entries(spark, journal)} == {"SUCCEEDED"}


def product(spark, days, count):
    return spark.createDataFrame([("Jovem", "D", "Neutro", count, 3.0, d) for d in days], "age_band string, department_name string, sentiment string, review_count int, avg_rating double, dt string").withColumn("dt", F.to_date("dt"))


def shown(df):
    return sorted((str(r.dt), r.review_count) for r in df.collect())


def test_readers_see_all_days_of_a_run_or_none(spark, workdir, monkeypatch):
    assert published_scan(spark, workdir).count() == 0 and unpublished_runs(spark, workdir) == []
    publish_days(product(spark, ["2024-01-01", "2024-01-02"], 1), workdir)
    early = published_scan(spark, workdir)
    torn = write_run(product(spark, ["2024-01-02", "2024-01-03"], 2), workdir)  # killed before it publishes
    assert shown(published_scan(spark, workdir)) == [("2024-01-01", 1), ("2024-01-02", 1)] and unpublished_runs(spark, workdir) == [torn]
    assert publish_run(spark, workdir, torn, emptied=["2024-01-01"]) == 2
    assert shown(published_scan(spark, workdir)) == [("2024-01-02", 2), ("2024-01-03", 2)]
    # a reader that began before keeps its days, and so does the manifest of that number
    assert shown(early) == shown(published_scan(spark, workdir, 1)) == [("2024-01-01", 1), ("2024-01-02", 1)]
    with pytest.raises(ValueError):
        drop_run(spark, workdir, torn)
    other = write_run(product(spark, ["2024-01-05"], 9), workdir)
    drop_run(spark, workdir, other)
    assert unpublished_runs(spark, workdir) == []


def test_two_runs_that_publish_at_once_keep_both_runs_days(spark, workdir, monkeypatch):
    publish_days(product(spark, ["2024-01-01"], 1), workdir)
    mine, theirs = (write_run(product(spark, [d], n), workdir) for d, n in (("2024-01-02", 2), ("2024-01-03", 3)))
    real, calls = publish._renamed, []

    def late(s, old, new):
        if not calls:
            calls.append(1)
            publish_run(s, workdir, theirs)
        return real(s, old, new)

    monkeypatch.setattr(publish, "_renamed", late)
    assert publish_run(spark, workdir, mine) == 3
    assert shown(published_scan(spark, workdir)) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)]
    assert sorted(r.dt for r in manifest(spark, workdir, 2).collect()) == ["2024-01-01", "2024-01-03"]
    monkeypatch.setattr(publish, "_renamed", lambda *_: False)
    with pytest.raises(PublishConflict):
        publish_run(spark, workdir, mine, attempts=2)


def test_batches_whose_place_cannot_be_made_cost_no_second_job(spark, workdir, monkeypatch):
    rows = numbered(spark, 95).withColumn("k", F.lpad("k", 4, "0"))
    os.makedirs(workdir.removeprefix("file:"))
    open(f"{workdir}/dt=2024-01-06".removeprefix("file:"), "w").close()
    written, real = [], ingest_module.write_raw_days_csv
    monkeypatch.setattr(ingest_module, "write_raw_days_csv", lambda *a, **k: written.append(1) or real(*a, **k))
    res = ingest(spark, rows, workdir, "k", batch_size=10)
    assert res.summary.first().asDict() == {"sent": 9, "ignored": 0, "errors": 1, "total": 10} and len(written) == 1
    assert [(str(r.dt), r.batch) for r in res.failed.collect()] == [("2024-01-06", "batch_006")]
    days = [f"dt=2024-01-{k:02d}" for k in range(1, 11)]
    assert sorted(n for n in os.listdir(workdir.removeprefix("file:")) if not n.startswith(".")) == ["_stored_batches", *days]
    os.remove(f"{workdir}/dt=2024-01-06".removeprefix("file:"))
    assert sorted(r.k for r in raw_scan(spark, workdir).collect()) == [f"{i:04d}" for i in range(95) if i // 10 != 5]


def test_stored_batches_are_listed_without_a_call_for_each_day(spark, workdir, monkeypatch):
    root = workdir.removeprefix("file:")
    for k in range(1, 6):
        os.makedirs(f"{root}/dt=2024-01-0{k}/batch=batch_00{k}")
    for name in ("batch_002.csv", "batch_x.csv", "notes.csv"):
        open(f"{root}/dt=2024-01-02/{name}", "w").close()
    os.makedirs(f"{root}/dt=2024-01-03/batch_003.csv")
    open(f"{root}/dt=2024-01-09", "w").close()
    monkeypatch.setattr(files, "children", None)
    assert [(str(r.dt), r.batch) for r in files.list_batches(spark, workdir).collect()] == [("2024-01-02", "batch_002")]
    assert files.list_batches(spark, f"{workdir}/none").count() == 0


def test_folders_are_dealt_to_few_tasks(spark):
    assert files._dealt(spark, [f"d{k}" for k in range(300)]).rdd.getNumPartitions() == 9
    assert files._dealt(spark, ["d"]).rdd.getNumPartitions() == 1
