"""Incremental runs: only new days are processed, results equal a batch run."""

from pyspark.sql import functions as F

from opinio.plans import derived
from opinio.plans.layout import Lake
from opinio.sources.files import product_scan
from opinio.sources.sinks import write_raw_days_csv
from opinio.streaming.incremental import process_new_days
from tests.conftest import SF001

def test_new_days_are_processed_once(spark, workdir):
    reviews = derived.event_reviews(spark, SF001)
    lake = Lake.under(workdir)
    ckpt = workdir + "/_stream"
    first = reviews.where(F.dayofmonth("dt") <= 10)
    write_raw_days_csv(first, lake.raw, mode="append")
    process_new_days(spark, lake, ckpt).awaitTermination()
    got = product_scan(spark, lake.product)
    assert got.select("dt").distinct().count() == 10
    write_raw_days_csv(reviews.where(F.dayofmonth("dt") > 10), lake.raw, mode="append")
    process_new_days(spark, lake, ckpt).awaitTermination()
    got = product_scan(spark, lake.product)
    expected = derived.event_product(spark, SF001).where("department_name <> ''")  # an empty CSV cell reads as null
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.select(*got.columns).collect()), key=str)


def test_late_file_reruns_its_day(spark, workdir):
    from opinio.operators.aggregate import product
    from opinio.operators.clean import clean

    reviews = derived.event_reviews(spark, SF001)
    lake = Lake.under(workdir)
    ckpt = workdir + "/_stream"
    day = F.to_date(F.lit("2024-01-05"))
    on_time = reviews.where((F.col("dt") == day) & (F.col("Clothing ID").cast("int") % 2 == 0))
    late = reviews.where((F.col("dt") == day) & (F.col("Clothing ID").cast("int") % 2 == 1))
    write_raw_days_csv(on_time, lake.raw, mode="append")
    process_new_days(spark, lake, ckpt).awaitTermination()
    first = product_scan(spark, lake.product).agg(F.sum("review_count")).first()[0]
    write_raw_days_csv(late, lake.raw, mode="append")  # a second file lands in the same day folder
    process_new_days(spark, lake, ckpt).awaitTermination()
    got = product_scan(spark, lake.product)
    expected = product(clean(reviews.where(F.col("dt") == day))).where("department_name <> ''")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.select(*got.columns).collect()), key=str)
    assert got.agg(F.sum("review_count")).first()[0] > first


def test_stream_lists_paths_only(spark, workdir, capsys):
    from opinio.streaming.incremental import landed_days

    lake = Lake.under(workdir)
    write_raw_days_csv(derived.event_reviews(spark, SF001), lake.raw, mode="append")
    q = landed_days(spark, lake).writeStream.format("memory").queryName("landed_days_probe").start()
    q.processAllAvailable()
    capsys.readouterr()
    q.explain()
    plan = capsys.readouterr().out
    q.stop()
    days = {r.dt for r in spark.table("landed_days_probe").collect()}
    assert len(days) == 30 and all(len(d) == 10 for d in days)
    read_schema = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read_schema and all("content" not in line for line in read_schema)  # file bytes never read


def test_bad_day_folder_does_not_stall_the_stream(spark, workdir):
    import shutil

    from opinio.sources.files import CSV_WRITE_OPTIONS

    reviews = derived.event_reviews(spark, SF001)
    lake = Lake.under(workdir)
    ckpt = workdir + "/_stream"
    write_raw_days_csv(reviews.where(F.dayofmonth("dt") <= 3), lake.raw, mode="append")
    sample = workdir + "/sample_csv"
    reviews.drop("dt").limit(5).coalesce(1).write.options(**CSV_WRITE_OPTIONS).csv(sample)
    shutil.copytree(sample, f"{lake.raw}/dt=2024-02-31")
    process_new_days(spark, lake, ckpt).awaitTermination()
    assert product_scan(spark, lake.product).select("dt").distinct().count() == 3
    log = {r.dt: r.status for r in spark.read.parquet(ckpt + "_runlog").collect()}
    assert log == {"2024-01-01": "SUCCEEDED", "2024-01-02": "SUCCEEDED", "2024-01-03": "SUCCEEDED", "2024-02-31": "FAILED"}
    # a later delivery is still picked up
    write_raw_days_csv(reviews.where(F.dayofmonth("dt") == 4), lake.raw, mode="append")
    process_new_days(spark, lake, ckpt).awaitTermination()
    assert product_scan(spark, lake.product).select("dt").distinct().count() == 4
