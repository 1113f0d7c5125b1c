"""Clean + aggregate on the band-edge sample, idempotence, emptied days,
multi-day = per-day equivalence, write guards."""

import pytest
from pyspark.sql import functions as F

from opinio.operators.aggregate import product
from opinio.operators.clean import HeaderCollision, clean
from opinio.operators.quality import EmptyPartition
from opinio.plans.backfill import backfill, run_days
from opinio.plans.daily import run_day
from opinio.plans.layout import Lake
from opinio.plans import derived
from opinio.schemas import PRODUCT_SCHEMA
from opinio.sources.files import MissingPartition, product_scan, trusted_scan
from opinio.sources.sinks import (
    PartitionColumnInFile,
    write_days_parquet,
    write_leaf_csv,
    write_leaf_parquet,
    write_raw_days_csv,
)
from tests.conftest import SF001, edge_product, edge_reviews, edge_rows

def _as_dict(df):
    return {(r.age_band, r.department_name, r.sentiment): (r.review_count, r.avg_rating) for r in df.collect()}


def _texts():
    return sum(1 for r in edge_rows() if (r[3] or "").strip(" "))


def test_edge_sample(spark):
    trusted = clean(edge_reviews(spark))
    assert trusted.count() == _texts()
    assert trusted.columns == [
        "clothing_id", "age", "title", "review_text", "rating", "recommended_ind",
        "division_name", "department_name", "class_name", "age_band",
    ]
    out = product(trusted)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in PRODUCT_SCHEMA]
    assert _as_dict(out) == edge_product()


def test_one_day_end_to_end_and_idempotent(spark, workdir):
    lake = Lake.under(workdir)
    day = "2024-01-01"
    write_leaf_csv(edge_reviews(spark), lake.raw, day)
    assert run_day(spark, lake, day) == len(edge_product())
    first = sorted(map(tuple, product_scan(spark, lake.product).collect()), key=str)
    assert run_day(spark, lake, day) == len(edge_product())  # re-run replaces, never appends
    second = sorted(map(tuple, product_scan(spark, lake.product).collect()), key=str)
    assert first == second
    assert trusted_scan(spark, lake.trusted, day).count() == _texts()
    assert "dt" not in trusted_scan(spark, lake.trusted, day).columns


def test_emptied_day_raises_empty_partition(spark, workdir):
    lake = Lake.under(workdir)
    day = "2024-12-31"
    write_leaf_csv(edge_reviews(spark), lake.raw, day)
    run_day(spark, lake, day)
    row = [("1000", "25", "title", "", "4", "1", "General", "Tops", "Knits")]
    one = spark.createDataFrame(row, edge_reviews(spark).schema)
    write_leaf_csv(one, lake.raw, day)
    with pytest.raises(EmptyPartition):
        run_day(spark, lake, day)
    assert product_scan(spark, lake.product).count() == 0


def test_missing_day(spark, workdir):
    with pytest.raises(MissingPartition):
        run_day(spark, Lake.under(workdir), "2024-02-02")


def test_leaf_write_refuses_dt(spark, workdir):
    df = spark.createDataFrame([("a", "2024-01-01")], "x string, dt string")
    with pytest.raises(PartitionColumnInFile):
        write_leaf_parquet(df, workdir, "2024-01-01")


def test_header_collision(spark):
    df = spark.createDataFrame([("1", "2")], "`Review Text` string, `review_text` string")
    with pytest.raises(HeaderCollision):
        clean(df)


def test_multi_day_equals_per_day(spark, workdir):
    """One job over all days gives the same product as day-by-day runs."""
    reviews = derived.event_reviews(spark, SF001)
    lake_all, lake_each = Lake.under(workdir + "/all"), Lake.under(workdir + "/each")
    write_raw_days_csv(reviews, lake_all.raw)
    write_raw_days_csv(reviews, lake_each.raw)
    res = backfill(spark, lake_all)
    assert res.exit_code == 0 and len(res.days) == 30
    for d in res.days[:5]:
        run_day(spark, lake_each, d)
    all_rows = product_scan(spark, lake_all.product).where(F.col("dt").isin(res.days[:5]))
    each_rows = product_scan(spark, lake_each.product)
    assert sorted(map(tuple, all_rows.collect()), key=str) == sorted(map(tuple, each_rows.collect()), key=str)
    expected = derived.event_product(spark, SF001).where(F.col("dt").isin(res.days[:5])).where("department_name <> ''")  # an empty CSV cell reads as null
    assert sorted(map(tuple, expected.collect()), key=str) == sorted(map(tuple, each_rows.collect()), key=str)


def test_multi_day_equals_per_day_with_mixed_headers(spark, workdir):
    """Columns permuted, one more and one less, day by day: every file is read by its own header."""
    from opinio.plans.scenarios import _write_mixed

    reviews = derived.event_reviews(spark, SF001).where(F.dayofmonth("dt") <= 8)
    lake_all, lake_each = Lake.under(workdir + "/all"), Lake.under(workdir + "/each")
    for lake in (lake_all, lake_each):
        _write_mixed(reviews, lake.raw)
    res = backfill(spark, lake_all)
    assert res.exit_code == 0 and len(res.days) == 8
    for d in res.days:
        run_day(spark, lake_each, d)
    rows = [sorted(map(tuple, product_scan(spark, x.product).collect()), key=str) for x in (lake_all, lake_each)]
    assert rows[0] == rows[1] and rows[0]
    names = trusted_scan(spark, lake_all.trusted).columns
    assert "extra_note" in names and "clothing_id" in names


def test_multi_day_overwrite_clears_emptied_day(spark, workdir):
    """Dynamic overwrite alone would keep the old rows of a day with no new rows."""
    root = workdir + "/prod"
    df = spark.createDataFrame(
        [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")], "k string, v int, dt string"
    ).withColumn("dt", F.to_date("dt"))
    assert write_days_parquet(df, root, ["2024-01-01", "2024-01-02"]) == []
    newer = df.where(F.col("dt") == F.to_date(F.lit("2024-01-02")))
    emptied = write_days_parquet(newer, root, ["2024-01-01", "2024-01-02"])
    assert emptied == ["2024-01-01"]
    back = spark.read.parquet(root)
    assert back.where(F.col("dt") == F.to_date(F.lit("2024-01-01"))).count() == 0
    assert back.count() == 1


def test_backfill_then_emptied_day_in_one_job(spark, workdir):
    reviews = derived.event_reviews(spark, SF001)
    lake = Lake.under(workdir)
    write_raw_days_csv(reviews, lake.raw)
    assert backfill(spark, lake).exit_code == 0
    first = "2024-01-01"
    blank = reviews.where(F.col("dt") == F.to_date(F.lit(first))).withColumn("Review Text", F.lit("")).drop("dt")
    write_leaf_csv(blank, lake.raw, first)
    counts = {r.dt.isoformat(): r.row_count for r in run_days(spark, lake, [first, "2024-01-02"]).collect()}
    assert counts[first] == 0 and counts["2024-01-02"] > 0
    assert trusted_scan(spark, lake.trusted, first).count() == 0


def _event_lake(spark, workdir):
    lake = Lake.under(workdir)
    write_raw_days_csv(derived.event_reviews(spark, SF001), lake.raw)
    return lake


def test_backfill_invalid_day_folder_fails_alone(spark, workdir, monkeypatch):
    import opinio.plans.backfill as bf

    import shutil

    from opinio.sources.files import CSV_WRITE_OPTIONS

    lake = _event_lake(spark, workdir)
    sample = workdir + "/sample_csv"
    derived.event_reviews(spark, SF001).drop("dt").coalesce(1).write.options(**CSV_WRITE_OPTIONS).csv(sample)
    for bad in ("2024-13-45", "2024-1-5"):
        shutil.copytree(sample, f"{lake.raw}/dt={bad}")
    single_runs = []
    monkeypatch.setattr(bf, "run_day", lambda *a, **k: single_runs.append(a[2]))
    res = backfill(spark, lake)
    rows = {r.dt: (r.status, r.error) for r in res.log.collect()}
    assert res.exit_code == 1 and len(rows) == 32
    assert rows["2024-13-45"][0] == "FAILED" and rows["2024-13-45"][1].startswith("InvalidDate")
    assert rows["2024-1-5"][0] == "FAILED"
    assert sum(1 for s, _ in rows.values() if s == "SUCCEEDED") == 30
    assert single_runs == []  # no day-by-day fallback


def test_backfill_bisects_around_a_failing_day(spark, workdir, monkeypatch):
    import opinio.plans.backfill as bf

    lake = _event_lake(spark, workdir)
    bad = "2024-01-17"
    real_run_days, calls = bf.run_days, []

    def flaky_run_days(spark_, lake_, days, table=None):
        calls.append(len(days))
        if bad in days:
            raise RuntimeError("disk full")
        return real_run_days(spark_, lake_, days, table)

    def failing_run_day(spark_, lake_, day, table=None):
        raise RuntimeError(f"disk full on {day}")

    monkeypatch.setattr(bf, "run_days", flaky_run_days)
    monkeypatch.setattr(bf, "run_day", failing_run_day)
    res = backfill(spark, lake)
    rows = {r.dt: (r.status, r.error) for r in res.log.collect()}
    assert res.exit_code == 1 and len(rows) == 30
    assert [d for d, (s, _) in rows.items() if s != "SUCCEEDED"] == [bad]
    assert rows[bad][1].startswith("RuntimeError | disk full")
    assert len(calls) <= 2 * 5 + 1  # about 2 * log2(30) multi-day jobs, not 30 single-day runs
    assert sum(n for n in calls if n) >= 30


def test_many_emptied_days_cleared_concurrently(spark, workdir):
    import datetime as dt

    root = workdir + "/prod_many"
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(20)]
    df = spark.createDataFrame([(f"k{i}", i, d) for i, d in enumerate(days)], "k string, v int, dt string").withColumn(
        "dt", F.to_date("dt")
    )
    assert write_days_parquet(df, root, days) == []
    only_last = df.where(F.col("dt") == F.to_date(F.lit(days[-1])))
    assert write_days_parquet(only_last, root, days) == days[:-1]
    back = spark.read.parquet(root)
    assert back.count() == 1 and back.first().k == "k19"
