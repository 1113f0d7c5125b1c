"""W1 batching, J1/A15 ingest idempotence."""

from pyspark.sql import functions as F

from opinio.operators.batching import assign_batches, with_row_index
from opinio.plans.ingest import ingest
from opinio.sources.files import list_batches, raw_scan


def test_23486_rows_make_235_days(spark):
    src = spark.range(23486).withColumnRenamed("id", "k")
    b = assign_batches(src, "k", 100, "2024-01-01")
    s = b.groupBy("dt", "batch").count()
    assert s.count() == 235
    assert s.agg(F.max("count")).first()[0] <= 100
    assert b.agg(F.max("dt")).first()[0].isoformat() == "2024-08-22"
    names = {r.batch for r in s.collect()}
    assert "batch_001" in names and "batch_235" in names


def test_250_rows_from_march(spark):
    src = spark.range(250).withColumnRenamed("id", "k")
    days = sorted(r.dt.isoformat() for r in assign_batches(src, "k", 100, "2024-03-10").select("dt").distinct().collect())
    assert days == ["2024-03-10", "2024-03-11", "2024-03-12"]


def test_row_index_matches_brute_force(spark):
    """Against a plain sort on the driver (small fixture), with skewed, sparse keys."""
    keys = [i * i % 100003 for i in range(3000)] + list(range(10**6, 10**6 + 500))
    keys = sorted(set(keys), key=lambda x: (x * 7919) % 10007)  # shuffled input order
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.row_index for r in with_row_index(df, "k", num_ranges=7).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_ingest_rerun_writes_nothing(spark, workdir):
    src = spark.range(1234).select(F.col("id").alias("k"), F.concat(F.lit('t "q",\n'), F.col("id")).alias("text"))
    root = workdir + "/raw"
    first = ingest(spark, src, root, "k", "2024-01-01", 100)
    assert first.summary.first().asDict() == {"sent": 13, "ignored": 0, "errors": 0, "total": 13}
    second = ingest(spark, src, root, "k", "2024-01-01", 100)
    assert second.summary.first().asDict() == {"sent": 0, "ignored": 13, "errors": 0, "total": 13}
    assert list_batches(spark, root).count() == 13
    back = raw_scan(spark, root)
    assert back.count() == 1234
    assert back.where(F.col("text") != F.concat(F.lit('t "q",\n'), F.col("k"))).count() == 0


def test_ingest_csv_follows_file_order(spark, workdir):
    from opinio.plans.ingest import ingest_csv

    # Keys deliberately out of order inside the file: file order must win.
    keys = [(i * 37) % 250 for i in range(250)]
    src = spark.createDataFrame([(str(k), f"text {k}") for k in keys], "`Clothing ID` string, `Review Text` string")
    csv_dir = workdir + "/source_csv"
    src.coalesce(1).write.options(header=True, escape='"').csv(csv_dir)
    res = ingest_csv(spark, csv_dir, workdir + "/raw", "2024-03-10", 100)
    assert res.exit_code == 0
    assert res.summary.first().asDict() == {"sent": 3, "ignored": 0, "errors": 0, "total": 3}
    back = raw_scan(spark, workdir + "/raw")
    assert not {"_file_name", "_file_block", "_file_pos"} & set(back.columns)
    first_batch = {r["Clothing ID"] for r in back.where(F.col("batch") == "batch_001").collect()}
    assert first_batch == {str(k) for k in keys[:100]}
    assert {r.dt.isoformat() for r in back.select("dt").distinct().collect()} == {"2024-03-10", "2024-03-11", "2024-03-12"}
    missing = ingest_csv(spark, workdir + "/no_such.csv", workdir + "/raw2")
    assert missing.exit_code == 2


def test_ingest_splittable_csv_keeps_file_order(spark, workdir):
    """A large single-line CSV is read in many splits; batches still follow file order."""
    from opinio.plans.ingest import ingest_csv
    from opinio.sources.files import source_scan

    keys = [(i * 7919) % 5003 for i in range(5003)]
    src = spark.createDataFrame([(str(k), f"text {k}") for k in keys], "`Clothing ID` string, `Review Text` string")
    csv_dir = workdir + "/big_csv"
    src.coalesce(1).write.options(header=True).csv(csv_dir)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert source_scan(spark, csv_dir, multi_line=False).rdd.getNumPartitions() > 4  # really split
        res = ingest_csv(spark, csv_dir, workdir + "/raw", "2024-01-01", 100, multi_line=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert res.summary.first().asDict() == {"sent": 51, "ignored": 0, "errors": 0, "total": 51}
    back = raw_scan(spark, workdir + "/raw")
    got = {r["Clothing ID"]: r["batch"] for r in back.select("Clothing ID", "batch").collect()}
    assert got == {str(k): f"batch_{i // 100 + 1:03d}" for i, k in enumerate(keys)}


def test_ingest_many_files_without_broadcast(spark, workdir):
    """Where nothing is broadcast the split offsets are joined by a shuffle; order is still file order."""
    import csv
    import glob

    from opinio.plans.ingest import ingest_csv

    keys = [(i * 7919) % 1201 for i in range(1201)]
    src = spark.createDataFrame([(str(k), f"text {k}") for k in keys], "`Clothing ID` string, `Review Text` string")
    csv_dir = workdir + "/many_csv"
    src.repartition(5).write.options(header=True).csv(csv_dir)
    in_file_order = []
    for path in sorted(glob.glob(csv_dir + "/part-*.csv")):
        with open(path, newline="") as fh:
            in_file_order += [row["Clothing ID"] for row in csv.DictReader(fh)]
    assert sorted(in_file_order) == sorted(str(k) for k in keys)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = ingest_csv(spark, csv_dir, workdir + "/raw", "2024-01-01", 100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert res.summary.first().asDict() == {"sent": 13, "ignored": 0, "errors": 0, "total": 13}
    back = raw_scan(spark, workdir + "/raw")
    got = {r["Clothing ID"]: r["batch"] for r in back.select("Clothing ID", "batch").collect()}
    assert got == {k: f"batch_{i // 100 + 1:03d}" for i, k in enumerate(in_file_order)}


def test_ingest_on_a_raw_layer_with_batch_files(spark, workdir):
    """A raw root holding ``dt=.../batch_001.csv`` files: those batches are kept,
    the missing ones are added as batch folders, and the mixed layout reads whole."""
    import csv
    import os

    root = workdir + "/raw"
    os.makedirs(root + "/dt=2024-03-10")
    with open(root + "/dt=2024-03-10/batch_001.csv", "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(["k", "text"])
        w.writerows([(i, f"text {i}") for i in range(100)])
    assert {(r.dt.isoformat(), r.batch) for r in list_batches(spark, root).collect()} == {("2024-03-10", "batch_001")}

    src = spark.range(250).select(F.col("id").alias("k"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    res = ingest(spark, src, root, "k", "2024-03-10", 100)
    assert res.summary.first().asDict() == {"sent": 2, "ignored": 1, "errors": 0, "total": 3}

    back = raw_scan(spark, root)
    assert back.count() == 250
    keys = {(r.dt.isoformat(), r.batch) for r in back.select("dt", "batch").distinct().collect()}
    assert keys == {("2024-03-10", "batch_001"), ("2024-03-11", "batch_002"), ("2024-03-12", "batch_003")}
    days = raw_scan(spark, root, days=["2024-03-10", "2024-03-11", "2024-03-12"])
    assert "batch" not in days.columns and days.count() == 250


def _partial_ingest(spark, workdir):
    """1000 rows in 10 batches; batches 3 and 7 already stored as batch files."""
    import csv
    import os

    root = workdir + "/raw"
    for day, name in (("2024-01-03", "batch_003"), ("2024-01-07", "batch_007")):
        os.makedirs(f"{root}/dt={day}")
        with open(f"{root}/dt={day}/{name}.csv", "w", newline="", encoding="utf-8") as fh:
            csv.writer(fh).writerows([("k", "text"), (-1, "kept")])
    src = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    res = ingest(spark, src, root, "k", "2024-01-01", 100)
    assert res.summary.first().asDict() == {"sent": 8, "ignored": 2, "errors": 0, "total": 10}
    got = {(r.k, r.batch) for r in raw_scan(spark, root).select(F.col("k").cast("int").alias("k"), "batch").collect()}
    expected = {(k, f"batch_{k // 100 + 1:03d}") for k in range(1000) if k // 100 not in (2, 6)}
    assert got == expected | {(-1, "batch_003"), (-1, "batch_007")}


def test_partial_ingest(spark, workdir):
    _partial_ingest(spark, workdir)


def test_row_index_with_one_range_or_only_null_leads(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (5, 0)], "k long, t long")
    got = {(r.k, r.t): r.row_index for r in with_row_index(df, ["k", "t"], num_ranges=1).collect()}
    assert got == {(None, 1): 0, (None, 2): 1, (5, 0): 2}
    nulls = df.where(F.col("k").isNull())
    got = {r.t: r.row_index for r in with_row_index(nulls, ["k", "t"], num_ranges=4).collect()}
    assert got == {1: 0, 2: 1}


def test_file_order_leaves_rows_in_place(spark, workdir):
    from opinio.operators.batching import with_file_index, with_file_position

    spark.range(5000).selectExpr("cast(id as string) as k").repartition(6).write.options(header=True).csv(workdir + "/csv")
    with_file_position(spark.read.options(header=True).csv(workdir + "/csv")).write.parquet(workdir + "/staged")
    rows = with_file_index(spark.read.parquet(workdir + "/staged"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("InMemoryRelation")[0]
    assert sorted(r.row_index for r in rows.collect()) == list(range(5000))


def test_key_order_moves_rows_once_and_only_for_missing_batches(spark, workdir):
    import re

    from opinio.plans.ingest import plan_ingest

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    number = lambda rows: with_row_index(rows, "doc_id")
    _, _, to_write = plan_ingest(spark, docs, workdir + "/raw", number)
    plan = to_write._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"Exchange rangepartitioning\([^)]*\), REPARTITION_BY_NUM", plan))) <= 1
    assert not re.search(r"Exchange hashpartitioning\((dt|batch)", plan)
    ingest(spark, docs, workdir + "/raw", "doc_id")

    def never(rows):
        raise AssertionError("no batch is missing: rows must not be numbered")

    assert plan_ingest(spark, docs, workdir + "/raw", never)[2] is None


def test_torn_batch_is_written_again(spark, workdir):
    """Part files of a batch without a completion record do not count as stored."""
    import glob
    import os
    import shutil

    root = workdir + "/raw"
    src = spark.range(1000).select(F.col("id").alias("k"))
    assert ingest(spark, src, root, "k").exit_code == 0
    shutil.rmtree(root + "/_stored_batches")
    parts = sorted(glob.glob(root + "/dt=2024-01-04/batch=*/part-*.csv"))
    os.remove(parts[0])
    res = ingest(spark, src, root, "k")
    assert res.summary.first().asDict() == {"sent": 10, "ignored": 0, "errors": 0, "total": 10}
    assert sorted(int(r.k) for r in raw_scan(spark, root).collect()) == list(range(1000))
    assert ingest(spark, src, root, "k").summary.first().asDict() == {"sent": 0, "ignored": 10, "errors": 0, "total": 10}


def test_failed_write_keeps_its_error(spark, workdir, monkeypatch):
    from opinio.plans import ingest as plan

    def broken(*_, **__):
        raise OSError("x" * 1000 + " disk full")

    monkeypatch.setattr(plan, "write_raw_days_csv", broken)
    res = plan.ingest(spark, spark.range(250).withColumnRenamed("id", "k"), workdir + "/raw", "k")
    assert res.exit_code == 1 and res.error.endswith("disk full") and len(res.error) > 1000
    assert res.summary.first().asDict() == {"sent": 0, "ignored": 0, "errors": 3, "total": 3}
    assert list_batches(spark, workdir + "/raw").count() == 0
