"""

Every query reads the driver's tables (or frames Spark derives from them) in
full.  Review rows come from ``events`` (see ``opinio.sources.reviews``);
batching runs on ``documents`` and on ``lineitem`` (a skewed lead key), ingest
on ``documents``.  Queries whose names end in
``_round_trip`` and the lake/ingest scenarios write under a fresh folder below
the session's shared checkpoint folder.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.rules import age_band, lenient_int, num, sentiment
from opinio.operators import quality, views
from opinio.operators.aggregate import dt_equals, dt_from
from opinio.operators.batching import assign_batches, batch_summary
from opinio.operators.clean import normalize_headers
from opinio.operators.daily_state import merged_stats, stored_states
from opinio.plans import derived, scenarios
from opinio.plans.backfill import run_summary
from opinio.plans.oracle import queries_sql
from opinio.sources.catalog import partition_diff, schema_contract, sync_partitions
from opinio.sources.files import list_partitions, product_scan, raw_scan, trusted_scan
from opinio.sources.publish import published_scan
from opinio.sources.storage import scratch_path

SMOKE_DIR = "/root/testdata/sf0.001"

PRODUCT_ORDER = ["age_band", "department_name", "sentiment", "review_count", "avg_rating", "dt"]
TRUSTED_ORDER = [
    "clothing_id", "age", "review_text", "rating", "recommended_ind", "department_name", "dt", "age_band",
]
BATCH_SIZE = 100
BATCH_START = "2024-01-01"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the multi-day data product on sf0.001."""
    return derived.event_product(spark, SMOKE_DIR)


def _reviews(spark, d):
    return normalize_headers(derived.event_reviews(spark, d))


def _product(spark, d):
    return derived.event_product(spark, d)


def _raw_days(spark, d):
    return derived.event_reviews(spark, d).select("dt").distinct()


def _raw_day_count(spark, d):
    return _raw_days(spark, d).select(F.count(F.lit(1))).scalar()


def _raw_first_day(spark, d):
    return derived.event_reviews(spark, d).select(F.min("dt")).scalar()


def _checks(spark, d):
    return quality.quality_checks(
        _product(spark, d),
        expected_partitions=_raw_day_count(spark, d),
        expected_min_dt=_raw_first_day(spark, d),
    )


def _batches(spark, d):
    docs = derived.table(spark, d, "documents")
    return assign_batches(docs, "doc_id", BATCH_SIZE, BATCH_START)


def _lineitem_batches(spark, d):
    """W1 with a skewed lead key: every line number holds up to a quarter of the rows."""
    items = derived.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return assign_batches(items, ["l_linenumber", "l_orderkey"], BATCH_SIZE, BATCH_START).select(
        "l_orderkey", "l_linenumber", "row_index", "batch_index", "dt", "batch"
    )


def _ingest_rerun_rows(spark, d):
    run = scenarios.ingest_twice(spark, d)
    return raw_scan(spark, run.root).select("doc_id", "text", "lang", "source", "n_chars", "dt", "batch")


def _report_json(spark, d):
    from opinio.plans.report import run_quality_report

    path = scratch_path(spark, "report") + "/validation_report"
    run_quality_report(
        spark,
        lambda: _product(spark, d),
        path,
        expected_partitions=_raw_day_count(spark, d),
        expected_min_dt=_raw_first_day(spark, d),
    )
    # expected/actual read as text: counts as digits, lists and ranges as compact JSON
    schema = (
        "generated_at string, database string, table string, checks array<struct<id:int, name:string, "
        "status:string, expected:string, actual:string, sql:string, detail:string>>, "
        "summary struct<pass:bigint, fail:bigint, overall:string>"
    )
    checks = spark.read.schema(schema).json(path).select(F.explode("checks").alias("c")).select("c.*")
    return checks.select(F.col("id").alias("check_id"), "name", "status", "expected", "actual", "sql", "detail")


def _runlog_round_trip(spark, d):
    from opinio.sources.files import CSV_READ_OPTIONS
    from opinio.sources.sinks import write_runlog

    path = scratch_path(spark, "runlog") + "/simulation_log"
    write_runlog(_lake(spark, d, "emptied").result.log, path)
    return spark.read.options(**CSV_READ_OPTIONS).csv(path).select("dt", "status", "error")


def _sql_functions(spark, d):
    from opinio.functions.rules import register_sql_functions

    register_sql_functions(spark)
    _reviews(spark, d).createOrReplaceTempView("opinio_reviews")
    return spark.sql(
        "SELECT clothing_id, age_band(age) AS age_band, "
        "sentiment(rating, recommended_ind) AS sentiment FROM opinio_reviews"
    )


def _saved_view_sql(spark, d):
    from opinio.sources.catalog import register_views

    register_views(spark.table(_lake(spark, d).table))
    return spark.sql("SELECT age_band, sentiment, total_reviews, media_nota FROM vw_sentiment_by_age")


def _saved_view(spark, d, name):
    """A saved query of the catalog."""
    from opinio.sources.catalog import SAVED_QUERIES, save_views

    saved = dict(zip(SAVED_QUERIES, save_views(spark, _lake(spark, d).table), strict=True))
    return spark.table(saved[name])


def _lake(spark, d, variant="full"):
    return scenarios.lake_run(spark, d, variant)


def _flawed(spark, d):
    """The stored table with null labels and a drifted partition (columns that drifted are not read)."""
    return spark.table(_lake(spark, d, "flawed").table)


def _large_ratings(spark, d):
    """The product with cell means beyond the exact decimal type."""
    return _product(spark, d).withColumn("avg_rating", F.col("review_count") * F.lit(2e14))


def _stored_checks(spark, d):
    return quality.quality_checks(
        _flawed(spark, d), expected_partitions=_raw_day_count(spark, d), expected_min_dt=_raw_first_day(spark, d)
    )


def _state_checks(spark, d):
    states = stored_states(spark, scenarios.state_run(spark, d).states)
    first = F.date_add(F.lit(_raw_first_day(spark, d)), 1)
    return quality.quality_checks(None, expected_partitions=_raw_day_count(spark, d) - 1, expected_min_dt=first, stats=merged_stats(states))


def _csv_ingested(spark, d):
    return raw_scan(spark, scenarios.ingest_after_torn_run(spark, d).root).select("doc_id", "text", "lang", "source", "n_chars", "dt", "batch")


def _training_data():
    """The module of the training-data queries; None where that subpackage or its pipeline is not installed."""
    try:
        importlib.import_module("corpus_pipeline")
        return importlib.import_module("opinio.llm.queries")
    except ModuleNotFoundError as missing:
        if missing.name in ("opinio.llm", "opinio.llm.queries", "corpus_pipeline"):
            return None
        raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # rules and cleaning
        "clean_reviews": lambda s, d: derived.event_trusted(s, d).select(*TRUSTED_ORDER),
        "age_band": lambda s, d: _reviews(s, d).select("clothing_id", "age", age_band("age").alias("age_band")),
        "sentiment": lambda s, d: _reviews(s, d).select(
            "clothing_id", "rating", "recommended_ind",
            sentiment("rating", "recommended_ind").alias("sentiment"),
        ),
        "lenient_number": lambda s, d: _reviews(s, d).select(
            "clothing_id", "age", num("age").alias("age_number"), lenient_int("age").alias("age_int")
        ),
        # product (A1-A3, P3, P6, P7, P8)
        "sql_functions": _sql_functions,
        "daily_product": lambda s, d: _product(s, d).select(*PRODUCT_ORDER),
        "lineitem_product": lambda s, d: derived.lineitem_product(s, d).select(*PRODUCT_ORDER),
        "product_for_day": lambda s, d: dt_equals(_product(s, d), "2024-01-15").drop("dt"),
        "product_from_day": lambda s, d: dt_from(_product(s, d), "2024-01-20").select(*PRODUCT_ORDER),
        # saved views
        "vw_sentiment_by_age": lambda s, d: views.vw_sentiment_by_age(_product(s, d)),
        "vw_sentiment_by_dept": lambda s, d: views.vw_sentiment_by_dept(_product(s, d)),
        "vw_daily_trend": lambda s, d: views.vw_daily_trend(_product(s, d)),
        "vw_sentiment_by_age_large": lambda s, d: views.vw_sentiment_by_age(_large_ratings(s, d)),
        # single checks over the stored table
        "check_distinct_dt": lambda s, d: _flawed(s, d).agg(F.count_distinct("dt").alias("n_dt")),
        "check_age_bands": lambda s, d: quality.distinct_sorted(_flawed(s, d), "age_band"),
        "check_sentiments": lambda s, d: quality.distinct_sorted(_flawed(s, d), "sentiment"),
        "check_null_age_band": lambda s, d: quality.null_rows(_flawed(s, d), "age_band").agg(
            F.count(F.lit(1)).alias("null_count")
        ),
        "check_null_sentiment": lambda s, d: quality.null_rows(_flawed(s, d), "sentiment").agg(
            F.count(F.lit(1)).alias("null_count")
        ),
        "check_dt_range": lambda s, d: _flawed(s, d).agg(F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt")),
        # report (D6, A17, U1)
        "quality_report": _checks,
        "quality_report_stored": _stored_checks,
        "quality_summary": lambda s, d: quality.quality_summary(_checks(s, d)),
        "quality_report_json": _report_json,
        # counts (A13, A14)
        "partition_counts": lambda s, d: quality.partition_counts(_product(s, d), _raw_days(s, d)),
        "table_count": lambda s, d: quality.table_count(_product(s, d)),
        # batching and ingest
        "assign_batches": lambda s, d: _batches(s, d).select(
            "doc_id", "text", "lang", "source", "n_chars", "row_index", "batch_index", "dt", "batch"
        ),
        "assign_batches_lineitem": _lineitem_batches,
        "batch_summary": lambda s, d: batch_summary(_batches(s, d), "doc_id"),
        "ingest_missing_batches": lambda s, d: scenarios.ingest_after_torn_run(s, d).missing,
        "ingest_csv_documents": _csv_ingested,
        "ingest_csv_summary": lambda s, d: scenarios.ingest_after_torn_run(s, d).result.summary,
        "ingest_first_summary": lambda s, d: scenarios.ingest_twice(s, d).first.summary,
        "ingest_summary": lambda s, d: scenarios.ingest_twice(s, d).second.summary,
        "ingest_rerun_rows": _ingest_rerun_rows,
        # one batch can't be written: the others are, and a re-run writes it
        "ingest_partial_summary": lambda s, d: scenarios.ingest_around_obstacle(s, d).first.summary,
        "ingest_failed_batches": lambda s, d: scenarios.ingest_around_obstacle(s, d).first.failed.select("dt", "batch"),
        "ingest_repaired_summary": lambda s, d: scenarios.ingest_around_obstacle(s, d).second.summary,
        "ingest_repaired_rows": lambda s, d: raw_scan(s, scenarios.ingest_around_obstacle(s, d).root).select(
            "doc_id", "text", "lang", "source", "n_chars", "dt", "batch"
        ),
        # a backfill continued by its journal
        "resumed_log": lambda s, d: scenarios.resumed_run(s, d).result.log.select("dt", "status", "error"),
        "resumed_product": lambda s, d: product_scan(s, scenarios.resumed_run(s, d).lake.product).select(*PRODUCT_ORDER),
        # states that days replace (A4-A12): no scan of the product
        "quality_report_states": _state_checks,
        "vw_sentiment_by_age_kept": lambda s, d: scenarios.state_run(s, d).by_age,
        "vw_sentiment_by_dept_kept": lambda s, d: scenarios.state_run(s, d).by_dept,
        # many days published in one step
        "published_before": lambda s, d: scenarios.published_run(s, d).before.select(*PRODUCT_ORDER),
        "published_product": lambda s, d: published_scan(s, scenarios.published_run(s, d).root).select(*PRODUCT_ORDER),
        # files, layers and catalog
        "csv_round_trip": lambda s, d: raw_scan(s, _lake(s, d).lake.raw).select(
            "Clothing ID", "Age", "Review Text", "Rating", "Recommended IND", "Department Name", "dt"
        ),
        "list_partitions": lambda s, d: list_partitions(s, _lake(s, d).lake.raw),
        "trusted_for_day": lambda s, d: trusted_scan(s, _lake(s, d).lake.trusted, "2024-01-15").select(
            *[c for c in TRUSTED_ORDER if c != "dt"]
        ),
        "trusted_round_trip": lambda s, d: trusted_scan(s, _lake(s, d).lake.trusted).select(*TRUSTED_ORDER),
        "product_round_trip": lambda s, d: product_scan(s, _lake(s, d).lake.product).select(*PRODUCT_ORDER),
        "idempotent_rerun": lambda s, d: product_scan(s, _lake(s, d, "rerun").table).select(*PRODUCT_ORDER),
        "mixed_header_backfill": lambda s, d: product_scan(s, _lake(s, d, "mixed").table).select(*PRODUCT_ORDER),
        "saved_view_sql": _saved_view_sql,
        "saved_view_dept": lambda s, d: _saved_view(s, d, "vw_sentiment_by_dept"),
        "saved_view_trend": lambda s, d: _saved_view(s, d, "vw_daily_trend"),
        "registered_table": lambda s, d: s.table(_lake(s, d).table).select(*PRODUCT_ORDER),
        "partition_sync": lambda s, d: sync_partitions(s, _lake(s, d).table),
        "schema_contract": lambda s, d: schema_contract(s, _lake(s, d, "flawed").table),
        "schema_contract_vanished": lambda s, d: schema_contract(s, _lake(s, d, "vanished").table),
        "partition_diff": lambda s, d: partition_diff(s, _lake(s, d, "vanished").table),
        "emptied_day_overwrite": lambda s, d: product_scan(s, _lake(s, d, "emptied_after").table).select(
            *PRODUCT_ORDER
        ),
        # incremental runs over newly landed days (Structured Streaming, availableNow)
        "incremental_product": lambda s, d: product_scan(s, scenarios.stream_run(s, d).product).select(
            *PRODUCT_ORDER
        ),
        # late rows are added to their days, which are not read again
        "late_rows_product": lambda s, d: product_scan(s, scenarios.late_run(s, d).product).select(*PRODUCT_ORDER),
        "backfill_log": lambda s, d: _lake(s, d, "emptied").result.log.select("dt", "status", "error"),
        "runlog_round_trip": _runlog_round_trip,
        "run_summary": lambda s, d: run_summary(_lake(s, d, "emptied").result.log).drop("duration_s"),
    }
    more = _training_data()
    return q | (more.queries() if more else {})


def oracle_sql() -> dict[str, str]:
    more = _training_data()
    sql = queries_sql() | (more.oracle_sql() if more else {})
    return {name: sql[name] for name in queries() if name in sql}
