"""Quality report (D6), backfill log (D5), catalog (K1-K5), trap tests."""

import json
import os

import pytest
from pyspark.sql import functions as F

from opinio.functions.dates import InvalidDate, parse_iso_date
from opinio.operators import quality, views
from opinio.operators.clean import clean
from opinio.plans import derived
from opinio.plans.backfill import backfill, run_summary, select_days
from opinio.plans.daily import run_day
from opinio.plans.layout import Lake
from opinio.plans.report import run_quality_report
from opinio.schemas import PRODUCT_TABLE_SCHEMA
from opinio.sources.catalog import (
    register_databases,
    register_product_table,
    register_views,
    schema_contract,
    sync_partitions,
    table_properties,
)
from opinio.sources.files import list_partitions, raw_scan
from opinio.sources.sinks import write_leaf_csv, write_raw_days_csv
from tests.conftest import SF001, SF01


def _product(spark):
    return derived.event_product(spark, SF001)


def test_six_checks_pass(spark):
    checks = quality.quality_checks(derived.event_product(spark, SF01), 30, "2024-01-01")
    rows = {r.check_id: r for r in checks.collect()}
    assert [rows[i].status for i in range(1, 7)] == ["PASS"] * 6
    assert rows[6].expected == "2024-01-01..2024-01-30"
    assert quality.quality_summary(checks).first().asDict() == {"pass_count": 6, "fail_count": 0, "overall": "PASS"}


def test_wrong_expectation_fails(spark, workdir):
    checks, doc, code = run_quality_report(
        spark, lambda: derived.event_product(spark, SF01), workdir + "/report", expected_partitions=100, expected_min_dt="2024-01-01"
    )
    st = {r.check_id: r.status for r in checks.collect()}
    assert st[1] == "FAIL" and st[6] == "FAIL" and code == 1
    assert doc["summary"] == {"pass": 4, "fail": 2, "overall": "FAIL"}
    files = [f for f in os.listdir(workdir + "/report") if f.startswith("part-")]
    with open(os.path.join(workdir, "report", files[0]), encoding="utf-8") as fh:
        written = json.loads(fh.read())
    assert written["checks"][0]["name"] == "COUNT DISTINCT dt"
    assert (written["database"], written["table"]) == ("customer_sentiment", "customer_sentiment_by_age")
    by_id = {c["id"]: c for c in written["checks"]}
    assert list(by_id[1]) == ["id", "name", "status", "expected", "actual", "sql", "detail"]
    assert (by_id[1]["expected"], by_id[1]["actual"], by_id[1]["detail"]) == (100, 30, "count=30")
    assert by_id[2]["expected"] == ["Adulto", "Jovem", "Madura", "Sênior"] == by_id[2]["actual"]
    assert by_id[2]["detail"] == "values=['Adulto', 'Jovem', 'Madura', 'Sênior']"
    assert by_id[6]["expected"] == {"min": "2024-01-01", "max": "2024-04-09"}
    assert by_id[6]["actual"] == {"min": "2024-01-01", "max": "2024-01-30"}
    assert by_id[4]["sql"] == "SELECT count_if(age_band IS NULL) FROM customer_sentiment.customer_sentiment_by_age"


def test_failing_scan_becomes_fail_rows(spark):
    def broken():
        return spark.read.parquet("/nonexistent/opinio/product")

    checks, _, code = run_quality_report(spark, broken, expected_partitions=30)
    rows = {r.check_id: r for r in checks.collect()}
    assert code == 1 and {r.status for r in rows.values()} == {"FAIL"} and len(rows) == 6
    assert rows[1].expected == "30" and rows[2].expected == "Adulto,Jovem,Madura,Sênior" and rows[6].expected == "2024-01-01..2024-01-30"
    assert all(r.actual is None and "opinio/product" in r.detail for r in rows.values())


def test_one_unreadable_column_fails_its_checks_only(spark):
    def load():
        return derived.event_product(spark, SF01).drop("sentiment")

    checks, _, code = run_quality_report(spark, load, expected_partitions=30, expected_min_dt="2024-01-01")
    assert code == 1
    assert {r.check_id: r.status for r in checks.collect()} == {1: "PASS", 2: "PASS", 3: "FAIL", 4: "PASS", 5: "FAIL", 6: "PASS"}


def test_run_duration_is_the_elapsed_time(spark):
    import datetime as dt

    from opinio.plans.backfill import status_log

    days = spark.range(2499).selectExpr("date_add(date'2020-01-01', cast(id as int)) as dt", "1L as row_count")
    start = dt.datetime(2024, 1, 1)
    for seconds in (60, 120, 300, 7):
        log = status_log(days, start, start + dt.timedelta(seconds=seconds), 2499)
        assert run_summary(log).first().duration_s == seconds


def test_whole_error_text_is_logged(spark, workdir, monkeypatch):
    import opinio.plans.backfill as bf

    def broken(*_, **__):
        raise RuntimeError("y" * 2000)

    lake = Lake.under(workdir)
    write_raw_days_csv(derived.event_reviews(spark, SF001).where(F.dayofmonth("dt") == 1), lake.raw)
    monkeypatch.setattr(bf, "run_days", broken)
    monkeypatch.setattr(bf, "run_day", broken)
    assert backfill(spark, lake).log.first().error == "RuntimeError | " + "y" * 2000


def test_date_arguments():
    assert parse_iso_date("2024-1-5").isoformat() == "2024-01-05"
    with pytest.raises(InvalidDate):
        parse_iso_date("05/01/2024")
    for bad in (" 2024-01-05", "2024-01-05\n", "2024-02-30", "02024-01-05"):
        with pytest.raises(InvalidDate):
            parse_iso_date(bad)


def test_backfill_listing_dry_run_and_log(spark, workdir):
    reviews = derived.event_reviews(spark, SF001)
    lake = Lake.under(workdir)
    write_raw_days_csv(reviews.where(F.dayofmonth("dt") <= 5), lake.raw)
    os.makedirs(lake.raw.replace("file:", "") + "/not_a_day", exist_ok=True)
    listed = [r.dt for r in list_partitions(spark, lake.raw).collect()]
    assert listed == [f"2024-01-0{i}" for i in range(1, 6)]
    assert [r.dt for r in select_days(spark, lake, "2024-01-03").collect()] == ["2024-01-03", "2024-01-04", "2024-01-05"]
    dry = backfill(spark, lake, dry_run=True)
    assert dry.log is None and dry.days == listed
    first = "2024-01-01"
    blank = reviews.where(F.col("dt") == F.to_date(F.lit(first))).withColumn("Review Text", F.lit("")).drop("dt")
    write_leaf_csv(blank, lake.raw, first)
    res = backfill(spark, lake)
    log = {r.dt: r for r in res.log.collect()}
    assert res.exit_code == 1
    assert log[first].status == "FAILED" and log[first].error.startswith("EmptyPartition")
    assert all(log[d].status == "SUCCEEDED" and log[d].error == "" for d in listed[1:])
    s = run_summary(res.log).first()
    assert (s.successes, s.failures, s.total, s.exit_code) == (4, 1, 5, 1)


def test_registered_table_and_contract(spark, workdir):
    reviews = derived.event_reviews(spark, SF001)
    lake = Lake.under(workdir)
    write_raw_days_csv(reviews, lake.raw)
    spark.sql("CREATE DATABASE IF NOT EXISTS opinio_test")
    register_product_table(spark, "opinio_test.product_t", lake.product)
    backfill(spark, lake, table="opinio_test.product_t")
    parts = [r[0] for r in sync_partitions(spark, "opinio_test.product_t").collect()]
    assert len(parts) == 30 and parts[0] == "dt=2024-01-01"
    t = spark.table("opinio_test.product_t")
    stored = _product(spark).where("department_name <> ''")  # an empty CSV cell reads as null
    assert t.count() == stored.count()
    assert {f.name: f.dataType for f in t.schema} == {f.name: f.dataType for f in PRODUCT_TABLE_SCHEMA}
    props = {r.key: r.value for r in table_properties(spark, "opinio_test.product_t").collect()}
    assert props["sla"] == "30min" and props["domain"] == "marketing" and props["product.owner"] == "data-team"
    contract = schema_contract(spark, "opinio_test.product_t").collect()
    assert {(r.column_name, r.status, r.partitions) for r in contract} == {(f.name, "OK", 30) for f in PRODUCT_TABLE_SCHEMA}
    day = spark.read.parquet(lake.product + "/dt=2024-01-02").withColumn("review_count", F.col("review_count").cast("bigint"))
    drifted = spark.createDataFrame(day.drop("sentiment").withColumn("extra", F.lit("x")).collect())
    drifted.write.mode("overwrite").parquet(lake.product + "/dt=2024-01-02")
    found = {(r.column_name, r.status): r.partitions for r in schema_contract(spark, "opinio_test.product_t").collect()}
    assert found["review_count", "TYPE_CHANGED"] == found["extra", "UNEXPECTED"] == found["sentiment", "MISSING"] == 1
    assert found["review_count", "OK"] == found["sentiment", "OK"] == 29 and found["dt", "OK"] == 30
    run_day(spark, lake, "2024-01-02", "opinio_test.product_t")
    spark.catalog.refreshTable("opinio_test.product_t")
    names = register_views(t)
    assert spark.table(names[0]).count() == views.vw_sentiment_by_age(stored).count()
    # The saved queries' latency limit: each under 10 s over the registered table.
    import time

    for name in names:
        t0 = time.perf_counter()
        spark.sql(f"SELECT * FROM {name}").collect()
        assert time.perf_counter() - t0 < 10, name
    t0 = time.perf_counter()
    quality.quality_checks(t, 30, "2024-01-01").collect()
    assert time.perf_counter() - t0 < 10


# ---- trap tests -----------------------------------------------------------

def test_t3_tab_newline_text_survives(spark):
    df = spark.createDataFrame([("\n\t", "25"), ("   ", "25"), ("", "25"), (None, "25"), ("x", "25")],
                               "`Review Text` string, Age string")
    assert clean(df).count() == 2


def test_t4_empty_department_dropped_after_csv(spark, workdir):
    df = spark.createDataFrame([("ok", "25", "4", "1", ""), ("ok", "25", "4", "1", "Tops")],
                               "`Review Text` string, Age string, Rating string, `Recommended IND` string, `Department Name` string")
    write_leaf_csv(df, workdir, "2024-01-01")
    from opinio.operators.aggregate import product

    out = product(clean(raw_scan(spark, workdir, "2024-01-01")))
    assert [r.department_name for r in out.collect()] == ["Tops"]


def test_t5_csv_quoting_round_trip(spark, workdir):
    text = 'She said "great", then\nleft, twice'
    df = spark.createDataFrame([(text, "25")], "`Review Text` string, Age string")
    write_leaf_csv(df, workdir, "2024-01-01")
    back = raw_scan(spark, workdir, "2024-01-01").collect()
    assert back[0]["Review Text"] == text


def test_t9_half_up_rounding(spark):
    from opinio.operators.aggregate import product

    rows = [("x", "25", "1", "1", "D")] * 39 + [("x", "25", "2", "1", "D")]  # mean 41/40 = 1.025
    df = spark.createDataFrame(rows, "review_text string, age string, rating string, recommended_ind string, department_name string")
    assert product(clean(df)).first().avg_rating == 1.03


def test_t8_t10_views_mean_of_means_and_bigint(spark):
    p = spark.createDataFrame(
        [("Jovem", "Tops", "Neutro", 1, 1.01), ("Jovem", "Dresses", "Neutro", 3, 1.02),
         ("Jovem", "Bottoms", "Neutro", 5, 1.02), ("Jovem", "Intimate", "Neutro", 7, 1.0)],
        "age_band string, department_name string, sentiment string, review_count int, avg_rating double",
    )
    r = views.vw_sentiment_by_age(p).first()
    assert r.total_reviews == 16 and r.media_nota == 1.01  # (1.01+1.02+1.02+1.00)/4 = 1.0125
    assert dict(views.vw_sentiment_by_age(p).dtypes)["total_reviews"] == "bigint"


def test_t13_label_order(spark):
    p = derived.event_product(spark, SF01)
    assert [r[0] for r in quality.distinct_sorted(p, "age_band").collect()] == ["Adulto", "Jovem", "Madura", "Sênior"]


def test_t2_unreadable_rating_counts_but_not_in_mean(spark):
    from opinio.operators.aggregate import product

    rows = [("x", "25", "4", "1", "D"), ("x", "25", "junk", "1", "D"), ("x", "25", "2", "0", "D")]
    df = spark.createDataFrame(rows, "review_text string, age string, rating string, recommended_ind string, department_name string")
    got = {r.sentiment: (r.review_count, r.avg_rating) for r in product(clean(df)).collect()}
    assert got == {"Positivo": (1, 4.0), "Negativo": (2, 2.0)}
    only_junk = spark.createDataFrame([("x", "25", "?", "1", "D")], df.schema)
    assert product(clean(only_junk)).first().avg_rating is None


def test_both_databases_are_registered(spark, workdir):
    register_databases(spark, {"opinio_sentiment_t": workdir + "/a", "opinio_trusted_t": workdir + "/b"})
    for name, place in (("opinio_sentiment_t", "/a"), ("opinio_trusted_t", "/b")):
        assert spark.catalog.getDatabase(name).locationUri.endswith(place)


def test_delivered_results(spark):
    from opinio.sources.files import TooManyRows, fetch_column, fetch_scalar, fetch_two, iterate_column

    many = spark.range(20_000)
    assert fetch_column(many.orderBy("id"))[-1] == 19_999 and len(fetch_column(many)) == 20_000
    assert fetch_scalar(many.agg(F.max("id"))) == 19_999 and fetch_scalar(many.limit(0)) is None
    with pytest.raises(TooManyRows):
        fetch_column(many, most=19_999)
    assert sum(1 for _ in iterate_column(many)) == 20_000
    assert fetch_two(many.agg(F.min("id"), F.max("id"))) == (0, 19_999) and fetch_two(many.limit(0)) == (None, None)


def test_listing_cost_follows_days_not_files(spark, workdir, monkeypatch):
    from opinio.sources import files

    spark.range(400).selectExpr("cast(id as string) as k", "date_add(date'2024-01-01', cast(id % 4 as int)) as dt").repartition(50).write.partitionBy("dt").csv(workdir + "/raw")
    calls = []
    real = files.children
    monkeypatch.setattr(files, "children", lambda s, p: calls.append(p) or real(s, p))
    assert [r.dt for r in list_partitions(spark, workdir + "/raw").collect()] == [f"2024-01-0{i}" for i in range(1, 5)]
    assert len(calls) == 1
    assert list_partitions(spark, workdir + "/absent").count() == 0


def test_cluster_session_without_a_checkpoint_folder_is_refused():
    from types import SimpleNamespace

    from opinio.sources.storage import NoCheckpointFolder, checkpoint_root

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        bare = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master), conf=SimpleNamespace(get=lambda *_: None))
        with pytest.raises(NoCheckpointFolder):
            checkpoint_root(bare)


def test_large_raw_file_is_split_without_multi_line(spark, workdir):
    rows = spark.range(20_000).selectExpr("cast(id as string) as Age", "repeat('x', 50) as `Review Text`")
    write_leaf_csv(rows.coalesce(1), workdir, "2024-01-01")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        assert raw_scan(spark, workdir, "2024-01-01", multi_line=False).rdd.getNumPartitions() > 4
        assert raw_scan(spark, workdir, "2024-01-01", multi_line=False).count() == 20_000
        assert raw_scan(spark, workdir, "2024-01-01").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_backfill_listing_error_exits_2(spark):
    from opinio.plans.backfill import backfill
    from opinio.plans.layout import Lake

    res = backfill(spark, Lake.under("nosuchfs://bucket/lake"))
    assert res.exit_code == 2 and res.log is None and res.days == [] and res.error


def test_t2_mean_reads_ratings_with_the_spark_cast(spark):
    """The mean uses Spark's cast (as the job does); the sentiment uses the Python rule."""
    from opinio.operators.aggregate import product
    from opinio.operators.views import vw_sentiment_by_age

    schema = "review_text string, age string, rating string, recommended_ind string, department_name string"
    rows = [("x", "25", " 4 ", "1", "D"), ("x", "25", "1d", "1", "D"), ("x", "25", "1_000", "1", "D")]
    got = {r.sentiment: (r.review_count, r.avg_rating) for r in product(clean(spark.createDataFrame(rows, schema))).collect()}
    # sentiment: " 4 " -> 4 Positivo, "1d" -> unreadable -> Negativo, "1_000" -> 1000 Positivo;
    # mean: " 4 " -> 4.0, "1d" -> 1.0, "1_000" -> unreadable
    assert got == {"Positivo": (2, 4.0), "Negativo": (1, 1.0)}
    nan_rows = [("x", "25", "nan", "1", "D"), ("x", "40", "4", "1", "D")]
    prod = product(clean(spark.createDataFrame(nan_rows, schema)))
    view = {r.age_band: r.media_nota for r in vw_sentiment_by_age(prod).collect()}
    assert view["Adulto"] == 4.0 and view["Jovem"] != view["Jovem"]  # NaN propagates, no failure


def test_contract_reads_every_file_of_a_partition(spark, workdir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    spark.sql("CREATE DATABASE IF NOT EXISTS opinio_test")
    register_product_table(spark, "opinio_test.product_files", f"{workdir}/files")
    good = _product(spark).drop("dt").limit(5)
    for day in ("2024-01-01", "2024-01-02"):
        good.coalesce(1).write.parquet(f"{workdir}/files/dt={day}")
    sync_partitions(spark, "opinio_test.product_files")
    before = schema_contract(spark, "opinio_test.product_files").collect()
    assert {(r.status, r.partitions) for r in before} == {("OK", 2)}
    folder = f"{workdir}/files/dt=2024-01-02"
    drifted = good.withColumn("review_count", F.col("review_count").cast("string")).withColumn("extra", F.lit(1)).drop("sentiment")
    drifted.coalesce(1).write.mode("append").parquet(folder)
    # a file that Spark did not write
    pq.write_table(pa.table({"review_count": pa.array([1.5])}), folder.removeprefix("file:") + "/late.parquet")
    found = {(r.column_name, r.actual_type, r.status): r.partitions for r in schema_contract(spark, "opinio_test.product_files").collect()}
    kind = dict(good.dtypes)["review_count"]
    assert found["review_count", kind, "OK"] == found["sentiment", "string", "OK"] == found["dt", "date", "OK"] == 2
    assert found["review_count", "string", "TYPE_CHANGED"] == found["review_count", "double", "TYPE_CHANGED"] == 1
    assert found["extra", "int", "UNEXPECTED"] == found["sentiment", None, "MISSING"] == 1


def test_vanished_and_new_folders_are_reported_and_nothing_is_dropped(spark, workdir):
    import shutil

    from opinio.sources.catalog import partition_diff

    spark.sql("CREATE DATABASE IF NOT EXISTS opinio_test")
    register_product_table(spark, "opinio_test.product_gone", f"{workdir}/gone")
    good = _product(spark).drop("dt").limit(5)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        good.coalesce(1).write.parquet(f"{workdir}/gone/dt={day}")
    sync_partitions(spark, "opinio_test.product_gone", ["2024-01-01", "2024-01-02"])
    shutil.rmtree(f"{workdir}/gone/dt=2024-01-01".removeprefix("file:"))
    want = {("dt=2024-01-01", True, False, "VANISHED"), ("dt=2024-01-02", True, True, "OK"), ("dt=2024-01-03", False, True, "NEW")}
    assert set(map(tuple, partition_diff(spark, "opinio_test.product_gone").collect())) == want
    found = {(r.column_name, r.status): r.partitions for r in schema_contract(spark, "opinio_test.product_gone").collect()}
    assert found["dt", "VANISHED"] == found["age_band", "OK"] == 1 and found["dt", "OK"] == 2
    assert {r[0] for r in sync_partitions(spark, "opinio_test.product_gone", ["2024-01-03"]).collect()} == {"dt=2024-01-01", "dt=2024-01-02", "dt=2024-01-03"}


def test_contract_reads_ends_of_files_only(tmp_path):
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    from opinio.sources.catalog import _stored_types

    for name, n in (("small", 1000), ("large", 3_000_000)):
        (tmp_path / name).mkdir()
        pq.write_table(pa.table({"x": np.random.default_rng(1).random(n)}), tmp_path / name / "f.parquet")
    read = []

    def counted():
        with open("/proc/self/io") as f:
            return int(next(line for line in f if line.startswith("rchar")).split()[1])

    for name in ("small", "large", "small", "large"):
        batch = pa.record_batch([[str(tmp_path / name)], ["dt=1"]], ["folder", "part"])
        before = counted()
        assert [b.to_pylist() for b in _stored_types(["x", "y"], iter([batch]))] == [[{"part": "dt=1", "name": "x", "type": "double"}, {"part": "dt=1", "name": "y", "type": None}]]
        read.append(counted() - before)
    assert (tmp_path / "large" / "f.parquet").stat().st_size > 20_000_000 and read[3] < 200_000


def test_saved_views_outlive_the_session_that_saved_them(spark, workdir):
    from opinio.sources.catalog import save_views

    register_databases(spark, {"opinio_saved_t": workdir + "/db"})
    table = "opinio_saved_t.cells"
    rows = [("Jovem", "D", "Neutro", n, mean, day) for n, mean, day in ((1, 4.33, "a"), (2, 4.34, "a"), (None, None, "b"), (3, 2e14, "b"), (4, 1.0, "c"))]
    rows += [("Adulto", "E", "Neutro", 7, 0.125, "a"), (None, "E", "Positivo", 1, 5.0, "b")]
    spark.createDataFrame(rows, "age_band string, department_name string, sentiment string, review_count int, avg_rating double, dt string").write.saveAsTable(table)
    names = save_views(spark, table)
    assert names == save_views(spark, table)  # saved again
    other = spark.newSession()
    for name in names:
        want = getattr(views, name.rpartition(".")[2])(spark.table(table))
        got = other.table(name)
        assert got.dtypes == want.dtypes and list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
