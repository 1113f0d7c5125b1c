"""End-to-end runs over a fresh lake, used by the I/O queries.

Each run writes under its own folder below the shared checkpoint root, never
under the input data.  Runs are remembered per session and input folder, so
queries reading the same lake do not rebuild it.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.plans import derived
from opinio.plans.backfill import BackfillResult, backfill
from opinio.plans.daily import run_day
from opinio.plans.ingest import IngestResult, ingest, ingest_csv
from opinio.plans.layout import Lake
from opinio.operators.batching import batch_keys, with_batches, with_row_index
from opinio.operators.ingest import missing_batches
from opinio.operators.quality import EmptyPartition
from opinio.schemas import PRODUCT_TABLE_SCHEMA
from opinio.sources.catalog import register_databases, register_product_table
from opinio.sources.files import CSV_WRITE_OPTIONS, day_path, list_batches, product_scan
from opinio.sources.sinks import record_batches, write_days_parquet, write_leaf_csv, write_raw_days_csv
from opinio.sources.storage import file_system, scratch_path

_RUNS: dict[tuple, object] = {}


@dataclass
class LakeRun:
    lake: Lake
    table: str
    result: BackfillResult
    first_day: str


def _key(spark: SparkSession, sf_dir: str, variant: str) -> tuple:
    app = spark.conf.get("spark.app.id", None) or str(id(spark))
    return (app, sf_dir.rstrip("/"), variant)


def _first_day(reviews: DataFrame) -> str:
    return reviews.agg(F.min("dt").cast("string").alias("d")).first()["d"]


def _blank_day(reviews: DataFrame, day: str) -> DataFrame:
    """The reviews of ``day`` with every text emptied (raw columns, no ``dt``)."""
    return (
        reviews.where(F.col("dt") == F.to_date(F.lit(day)))
        .withColumn("Review Text", F.lit(""))
        .drop("dt")
    )


def lake_run(spark: SparkSession, sf_dir: str, variant: str = "full") -> LakeRun:
    """Build a lake from the ``events`` reviews and backfill it.

    * ``full``: every day as given.
    * ``emptied``: the first day's texts are blank before the backfill, so that
      day fails its gate.
    * ``emptied_after``: a full backfill, then the first day is re-delivered
      with blank texts and re-run on its own (its product must become empty).
    * ``rerun``: backfilled twice.
    * ``mixed``: the days' files have different headers (columns permuted, one
      more, one less).
    * ``flawed``: after the backfill the first day's product gets rows with null
      labels, and the last day's is replaced by files with other types.
    * ``vanished``: after the backfill the first day's product folder is deleted
      from outside, and the last day's is copied to the day after it.
    """
    key = _key(spark, sf_dir, variant)
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, f"lake-{variant}")
    lake = Lake.under(root)
    reviews = derived.event_reviews(spark, sf_dir)
    first = _first_day(reviews)
    if variant == "mixed":
        _write_mixed(reviews, lake.raw)
    else:
        write_raw_days_csv(reviews, lake.raw)
    if variant == "emptied":
        write_leaf_csv(_blank_day(reviews, first), lake.raw, first)
    register_databases(spark, {"customer_sentiment": f"{root}/catalog", "reviews_trusted": f"{root}/catalog_trusted"})
    table = f"customer_sentiment.customer_sentiment_by_age_{uuid.uuid4().hex[:8]}"
    register_product_table(spark, table, lake.product)
    result = backfill(spark, lake, table=table)
    if variant == "emptied_after":
        write_leaf_csv(_blank_day(reviews, first), lake.raw, first)
        try:
            run_day(spark, lake, first, table)
        except EmptyPartition:
            pass
    if variant == "rerun":
        backfill(spark, lake, table=table)
    if variant == "flawed":
        _spoil(spark, lake, table, first, max(result.days))
    if variant == "vanished":
        after = day_path(lake.product, _dt.date.fromisoformat(max(result.days)) + _dt.timedelta(days=1))
        spark.read.parquet(day_path(lake.product, max(result.days))).write.parquet(after)
        store, folder = file_system(spark, day_path(lake.product, first))
        store.delete(folder, True)
    run = LakeRun(lake, table, result, first)
    _RUNS[key] = run
    return run


def _write_mixed(reviews: DataFrame, root: str) -> None:
    """Days by day of month modulo 4: as they are, columns reversed, one column more, one less."""
    names = [c for c in reviews.columns if c != "dt"]
    shapes = [
        reviews,
        reviews.select(*reversed(names), "dt"),
        reviews.withColumn("Extra Note", F.lit("x")).select("Extra Note", *names, "dt"),
        reviews.drop("Clothing ID"),
    ]
    for k, shape in enumerate(shapes):
        write_raw_days_csv(shape.where(F.dayofmonth("dt") % 4 == k), root)


def _spoil(spark: SparkSession, lake: Lake, table: str, first: str, last: str) -> None:
    """Null labels beside the first day's product; other types and a further column in the last day's."""
    product = product_scan(spark, lake.product)
    some = product.where(F.col("dt") == F.lit(first)).drop("dt")
    nulls = some.withColumn("age_band", F.lit(None).cast("string")).union(some.withColumn("sentiment", F.lit(None).cast("string")))
    nulls.write.mode("append").parquet(day_path(lake.product, first))
    other = product.where(F.col("dt") == F.lit(last)).drop("dt").withColumn("review_count", F.col("review_count").cast("bigint"))
    other = other.withColumn("avg_rating", F.col("avg_rating").cast("string")).withColumn("extra", F.lit(1))
    kept = spark.createDataFrame(other.collect(), other.schema)  # one day's product: bands x departments x labels
    kept.write.mode("overwrite").parquet(day_path(lake.product, last))
    spark.catalog.refreshTable(table)


@dataclass
class IngestRun:
    root: str
    first: IngestResult
    second: IngestResult


def ingest_twice(spark: SparkSession, sf_dir: str) -> IngestRun:
    """Ingest ``documents`` (ordered by ``doc_id``) twice into one fresh raw root."""
    key = _key(spark, sf_dir, "ingest")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "ingest") + "/raw/documents"
    docs = derived.table(spark, sf_dir, "documents")
    first = ingest(spark, docs, root, "doc_id")
    second = ingest(spark, docs, root, "doc_id")
    run = IngestRun(root, first, second)
    _RUNS[key] = run
    return run


@dataclass
class ObstructedIngestRun:
    root: str
    first: IngestResult
    second: IngestResult


def ingest_around_obstacle(spark: SparkSession, sf_dir: str) -> ObstructedIngestRun:
    """Ingest ``documents`` where the last batch's day folder can't be made (a file has its name),
    then again without that file."""
    key = _key(spark, sf_dir, "ingest-obstacle")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "ingest-obstacle") + "/raw"
    docs = derived.table(spark, sf_dir, "documents")
    last = batch_keys(spark, docs.count(), 100, "2024-01-01").agg(F.max("dt")).first()[0]
    store, place = file_system(spark, day_path(root, last))
    store.create(place).close()
    first = ingest(spark, docs, root, "doc_id")
    first.summary, first.failed = (_fixed(df) for df in (first.summary, first.failed))
    store.delete(place, False)
    run = ObstructedIngestRun(root, first, ingest(spark, docs, root, "doc_id"))
    _RUNS[key] = run
    return run


def _fixed(df: DataFrame) -> DataFrame:
    """A small frame (a summary, failed batches, the product of some days) as it is now."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@dataclass
class PartialIngestRun:
    root: str
    missing: DataFrame
    result: IngestResult


def ingest_after_torn_run(spark: SparkSession, sf_dir: str) -> PartialIngestRun:
    """Ingest ``documents`` as CSV into a raw root where an earlier run has left
    every third batch stored, and the second batch torn (part of its rows, no record)."""
    key = _key(spark, sf_dir, "ingest-torn")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "ingest-torn")
    docs = derived.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.options(**CSV_WRITE_OPTIONS).csv(f"{root}/source")
    rows = with_batches(with_row_index(docs, "doc_id"), 100, "2024-01-01").drop("row_index")
    stored = rows.where("batch_index % 3 = 0").drop("batch_index")
    write_raw_days_csv(stored, f"{root}/raw", by=("dt", "batch"))
    record_batches(stored.select("dt", "batch").distinct(), f"{root}/raw")
    write_raw_days_csv(rows.where("batch_index = 1 and doc_id % 2 = 0").drop("batch_index"), f"{root}/raw", by=("dt", "batch"))
    keys = batch_keys(spark, docs.count(), 100, "2024-01-01")
    missing = missing_batches(keys, list_batches(spark, f"{root}/raw")).collect()  # keys of batches, before the run
    run = PartialIngestRun(f"{root}/raw", spark.createDataFrame(missing, "dt date, batch string"), ingest_csv(spark, f"{root}/source", f"{root}/raw"))
    _RUNS[key] = run
    return run


@dataclass
class ResumedRun:
    lake: Lake
    result: BackfillResult


def resumed_run(spark: SparkSession, sf_dir: str) -> ResumedRun:
    """A backfill whose journal already holds the first half of the days, of which one has since been
    re-delivered empty: only the other days are run."""
    key = _key(spark, sf_dir, "resumed")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "lake-resumed")
    lake = Lake.under(root)
    reviews = derived.event_reviews(spark, sf_dir)
    first, middle = _first_day(reviews), _middle_day(reviews)
    write_raw_days_csv(reviews.where(F.col("dt") <= F.lit(middle)), lake.raw)
    backfill(spark, lake, journal=f"{root}/journal", wave=7)
    write_raw_days_csv(reviews.where(F.col("dt") > F.lit(middle)), lake.raw, mode="append")
    write_leaf_csv(_blank_day(reviews, first), lake.raw, first)
    run = ResumedRun(lake, backfill(spark, lake, journal=f"{root}/journal", wave=7))
    _RUNS[key] = run
    return run


def _middle_day(reviews: DataFrame) -> _dt.date:
    span = reviews.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    return span.select(F.date_add("lo", (F.datediff("hi", "lo") / 2).cast("int"))).first()[0]


@dataclass
class PublishedRun:
    root: str
    before: DataFrame
    torn: list[str]


def published_run(spark: SparkSession, sf_dir: str) -> PublishedRun:
    """The product published in two runs with a torn one between them (all days of it written, none published)."""
    from opinio.sources.publish import published_scan, publish_days, unpublished_runs, write_run

    key = _key(spark, sf_dir, "published")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "published")
    product = derived.event_product(spark, sf_dir)
    middle = _middle_day(product)
    publish_days(product.where(F.col("dt") <= F.lit(middle)), root)
    write_run(product.withColumn("review_count", F.lit(-1)), root)
    before, torn = published_scan(spark, root), unpublished_runs(spark, root)
    # the later days, and the middle one emptied
    publish_days(product.where(F.col("dt") > F.lit(middle)), root, emptied=[middle])
    run = PublishedRun(root, before, torn)
    _RUNS[key] = run
    return run


@dataclass
class StateRun:
    states: str
    by_age: DataFrame
    by_dept: DataFrame


def state_run(spark: SparkSession, sf_dir: str) -> StateRun:
    """Day states and view totals kept through an append, an overwrite and an emptied day: the days up to the
    middle, then a changed middle day, then the true middle day with all later ones, then the first day emptied."""
    from opinio.operators import daily_state as state

    key = _key(spark, sf_dir, "states")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "states")
    product = derived.event_product(spark, sf_dir).select(*PRODUCT_TABLE_SCHEMA.names)
    middle, first = _middle_day(product), _first_day(product)
    days = [r.dt for r in product.select("dt").distinct().orderBy("dt").collect()]
    changed = product.where(F.col("dt") == F.lit(middle)).withColumn("avg_rating", F.col("avg_rating") + 7).withColumn("age_band", F.lit(None).cast("string"))
    steps = [
        ([d for d in days if d <= middle], product.where(F.col("dt") <= F.lit(middle))),
        ([middle], changed),
        ([d for d in days if d >= middle], product.where(F.col("dt") >= F.lit(middle))),
        ([first], product.limit(0)),
    ]
    views = {"by_age": ["age_band", "sentiment"], "by_dept": ["department_name", "sentiment"]}
    totals = {name: state.view_totals(product.limit(0), keys) for name, keys in views.items()}
    for k, (some, rows) in enumerate(steps):
        old = _fixed(state.product_days(spark, f"{root}/product", some, PRODUCT_TABLE_SCHEMA))
        write_days_parquet(rows, f"{root}/product", some, repartition_by_day=True)
        new = state.product_days(spark, f"{root}/product", some, PRODUCT_TABLE_SCHEMA)
        state.replace_states(new, f"{root}/states", some)
        for name, keys in views.items():
            state.after_rerun(totals[name], old, new, keys).write.parquet(f"{root}/{name}/{k}")
            totals[name] = spark.read.parquet(f"{root}/{name}/{k}")
    now = product_scan(spark, f"{root}/product")
    run = StateRun(f"{root}/states", *(state.view_of_totals(totals[name], now, keys) for name, keys in views.items()))
    _RUNS[key] = run
    return run


def stream_run(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw days land in two deliveries; each is picked up by an incremental run."""
    from opinio.streaming.incremental import process_new_days

    key = _key(spark, sf_dir, "stream")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "lake-stream")
    lake = Lake.under(root)
    reviews = derived.event_reviews(spark, sf_dir)
    middle = _middle_day(reviews)
    for part in (reviews.where(F.col("dt") <= F.lit(middle)), reviews.where(F.col("dt") > F.lit(middle))):
        write_raw_days_csv(part, lake.raw, mode="append")
        process_new_days(spark, lake, f"{root}/_stream_checkpoint").awaitTermination()
    _RUNS[key] = lake
    return lake


def late_run(spark: SparkSession, sf_dir: str) -> Lake:
    """Rows land in three deliveries: the later half of the days without a third of their rows, the days before,
    and the rows held back; only a delivery's own files are read when it lands."""
    from opinio.streaming.late_rows import process_late_rows

    key = _key(spark, sf_dir, "late")
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "lake-late")
    lake = Lake.under(root)
    reviews = derived.event_reviews(spark, sf_dir)
    late = F.pmod(F.hash("Clothing ID", "Review Text"), F.lit(3)) == 0
    second_half = F.col("dt") > F.lit(_middle_day(reviews))
    for part in (reviews.where(second_half & ~late), reviews.where(~second_half), reviews.where(second_half & late)):
        write_raw_days_csv(part, lake.raw, mode="append")
        process_late_rows(spark, lake, f"{root}/cells", f"{root}/_stream_checkpoint").awaitTermination()
    _RUNS[key] = lake
    return lake
