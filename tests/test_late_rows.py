"""Late rows added to their days: equal to the batch product, whatever lands when."""

import random

from pyspark.sql import functions as F

from opinio.operators.aggregate import product
from opinio.operators.clean import clean
from opinio.plans.layout import Lake
from opinio.sources.files import CSV_WRITE_OPTIONS, product_scan, raw_scan
from opinio.streaming import late_rows
from tests.conftest import edge_rows

HEADER = ["Clothing ID", "Age", "Title", "Review Text", "Rating", "Recommended IND", "Division Name", "Department Name", "Class Name"]
DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def put(spark, lake, day, name, rows, header=HEADER):
    """A raw file of ``rows``; its path."""
    place = f"{lake.raw}/dt={day}/batch={name}"
    order = [HEADER.index(h) for h in header]
    frame = spark.createDataFrame([[r[i] for i in order] for r in rows], ", ".join(f"`{h}` string" for h in header))
    frame.coalesce(1).write.options(**CSV_WRITE_OPTIONS).csv(place)
    return [r[0] for r in spark.read.format("binaryFile").load(f"{place}/*.csv").select("path").collect()][0]


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(key, got.collect())) == sorted(map(key, want.select(*got.columns).collect()))


def test_files_in_any_order_equal_the_batch_product(spark, workdir):
    rng = random.Random(3)
    lake, state = Lake.under(workdir), f"{workdir}/cells"
    rows = edge_rows()
    rng.shuffle(rows)
    files = []
    for i in range(6):
        some = rows[i::6]
        if i == 4:  # ratings in fractions that the sums hold, and unreadable ones
            some = [(*r[:4], rng.choice(["2.5", "x", "4.25", ""]), *r[5:]) for r in some]
        if i == 5:  # one that they don't: this day is run as a whole
            some = [(*some[0][:4], "4.1", *some[0][5:]), *some[1:]]
        day = DAYS[2] if i == 5 else DAYS[i % 2]
        files.append(put(spark, lake, day, f"batch_{i:03}", some, HEADER[::-1] if i % 3 == 1 else HEADER))
    rng.shuffle(files)
    for epoch, some in enumerate((files[:1], files[1:4], files[4:])):
        late_rows.apply_files(spark, lake, state, some, epoch, fold_after=2)
        late_rows.apply_files(spark, lake, state, some, epoch, fold_after=2)  # a replay
    assert same(product_scan(spark, lake.product), product(clean(raw_scan(spark, lake.raw, days=DAYS))))
    odd = late_rows.day_cells(spark, state, DAYS).where("odd > 0").select("dt").distinct().collect()
    assert [r[0].isoformat() for r in odd] == [DAYS[2]]


def test_earlier_files_are_not_read_again(spark, workdir):
    lake, elsewhere, state = Lake.under(workdir), Lake.under(f"{workdir}/elsewhere"), f"{workdir}/cells"
    rows = edge_rows()
    late_rows.apply_files(spark, lake, state, [put(spark, elsewhere, DAYS[0], "batch_001", rows[::2])], 0)
    second = put(spark, lake, DAYS[0], "batch_002", rows[1::2])
    both = raw_scan(spark, elsewhere.raw, days=DAYS[:1]).unionByName(raw_scan(spark, lake.raw, days=DAYS[:1]))
    log = late_rows.apply_files(spark, lake, state, [second], 1)  # the first file is not in the lake's raw layer
    assert same(product_scan(spark, lake.product), product(clean(both))) and [r[:2] for r in log] == [(DAYS[0], "SUCCEEDED")]
    # the state made anew holds what the raw layer has
    late_rows.rebuild_days(spark, lake, state, DAYS[:1])
    assert same(product_scan(spark, lake.product), product(clean(raw_scan(spark, lake.raw, days=DAYS[:1]))))


def test_days_without_rows_and_folders_that_are_no_days(spark, workdir):
    lake, elsewhere, state = Lake.under(workdir), Lake.under(f"{workdir}/elsewhere"), f"{workdir}/cells"
    empty = [("1", "30", "t", "  ", "5", "1", "D", "N", "C")]
    blank = put(spark, lake, DAYS[0], "batch_001", empty)
    odd = put(spark, lake, "2024-02-31", "batch_001", edge_rows()[:5])
    good = put(spark, elsewhere, DAYS[1], "batch_001", edge_rows()[:50])
    log = late_rows.apply_files(spark, lake, state, [blank, odd, good], 0)
    assert [r[:2] for r in log] == [(DAYS[0], "FAILED"), (DAYS[1], "SUCCEEDED"), ("2024-02-31", "FAILED")]
    assert product_scan(spark, lake.product).select("dt").distinct().count() == 1
    # a day whose raw files have no rows left is empty once it is made anew
    put(spark, lake, DAYS[1], "batch_002", empty)
    late_rows.rebuild_days(spark, lake, state, [DAYS[1]])
    assert product_scan(spark, lake.product).count() == 0


def test_stream_adds_each_delivery_once(spark, workdir):
    lake, state, checkpoint = Lake.under(workdir), f"{workdir}/cells", f"{workdir}/_stream"
    rows = edge_rows()
    for k in range(3):
        put(spark, lake, DAYS[k % 2], f"batch_{k:03}", rows[k::3])
        late_rows.process_late_rows(spark, lake, state, checkpoint, max_files=1).awaitTermination()
    assert same(product_scan(spark, lake.product), product(clean(raw_scan(spark, lake.raw, days=DAYS[:2]))))
    log = spark.read.parquet(f"{checkpoint}_runlog").groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
    assert [(r.status, r.n) for r in log] == [("SUCCEEDED", 3)]
