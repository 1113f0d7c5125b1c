"""Benchmark the headline jobs; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Review rows are derived from ``lineitem`` (largest table) and ``events`` and
landed once as Parquet files, the way raw reviews arrive as files.  The timed
steps are the pipeline's jobs:

* ``product_lineitem`` / ``product_events``: clean + classify + aggregate for
  every day at once (multi-day D1+D2 logic), forced with the no-op sink;
* ``backfill_events``: the full D5 job over a CSV raw layer (trusted and
  product writes, emptied-day handling, per-day gate) for all days;
* ``vw_*`` and ``quality_report``: the saved queries and the six checks over
  the registered product table (per-query latency);
* ``assign_batches_documents`` / ``ingest_documents``: W1 numbering and D4;
* ``ingest_csv_documents``: D4 from a landed CSV copy of ``documents`` in
  file order (parsed once into a staging table, then numbered and written).

The session start, landing and one warm-up query are not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opinio.operators import quality, views  # noqa: E402
from opinio.operators.aggregate import product  # noqa: E402
from opinio.operators.batching import assign_batches  # noqa: E402
from opinio.operators.clean import clean  # noqa: E402
from opinio.plans import derived  # noqa: E402
from opinio.plans.backfill import backfill  # noqa: E402
from opinio.plans.ingest import ingest, ingest_csv  # noqa: E402
from opinio.plans.layout import Lake  # noqa: E402
from opinio.session import build_session  # noqa: E402
from opinio.sources.catalog import register_product_table, sync_partitions  # noqa: E402
from opinio.sources.files import CSV_WRITE_OPTIONS  # noqa: E402
from opinio.sources.sinks import write_raw_days_csv  # noqa: E402
from opinio.sources.storage import scratch_path  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="opinio-bench-")  # one machine: the folder is shared
    spark = build_session(f"local[{cpus}]", "opinio-bench", shuffle_partitions=int(cpus), extra={"spark.checkpoint.dir": scratch})

    landing = scratch_path(spark, "bench-landing")
    derived.lineitem_reviews(spark, sf_dir).write.parquet(f"{landing}/lineitem_reviews")
    derived.event_reviews(spark, sf_dir).write.parquet(f"{landing}/event_reviews")
    li_reviews = spark.read.parquet(f"{landing}/lineitem_reviews")
    ev_reviews = spark.read.parquet(f"{landing}/event_reviews")
    _run(product(clean(ev_reviews)))  # warm-up

    derived.table(spark, sf_dir, "documents").write.options(**CSV_WRITE_OPTIONS).csv(f"{landing}/documents_csv")

    lake = Lake.under(scratch_path(spark, "bench-lake"))
    write_raw_days_csv(derived.event_reviews(spark, sf_dir), lake.raw)
    spark.sql("CREATE DATABASE IF NOT EXISTS customer_sentiment")
    table = "customer_sentiment.customer_sentiment_by_age_bench"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    register_product_table(spark, table, lake.product)

    def product_lineitem():
        _run(product(clean(li_reviews)))

    def product_events():
        _run(product(clean(ev_reviews)))

    def backfill_events():
        result = backfill(spark, lake, table=table)
        assert result.exit_code == 0, "backfill reported failed days"
        sync_partitions(spark, table)

    def view(build):
        return lambda: build(spark.table(table)).collect()

    def quality_report():
        days = len(spark.sql(f"SHOW PARTITIONS {table}").collect())
        quality.quality_checks(spark.table(table), days, "2024-01-01").collect()

    def assign_batches_documents():
        docs = derived.table(spark, sf_dir, "documents")
        _run(assign_batches(docs, "doc_id", 100, "2024-01-01"))

    def ingest_documents():
        root = scratch_path(spark, "bench-ingest") + "/raw"
        res = ingest(spark, derived.table(spark, sf_dir, "documents"), root, "doc_id")
        assert res.exit_code == 0

    def ingest_csv_documents():
        root = scratch_path(spark, "bench-ingest-csv") + "/raw"
        res = ingest_csv(spark, f"{landing}/documents_csv", root)
        assert res.exit_code == 0

    plan = [
        ("product_lineitem", product_lineitem),
        ("product_events", product_events),
        ("backfill_events", backfill_events),
        ("vw_sentiment_by_age", view(views.vw_sentiment_by_age)),
        ("vw_sentiment_by_dept", view(views.vw_sentiment_by_dept)),
        ("vw_daily_trend", view(views.vw_daily_trend)),
        ("quality_report", quality_report),
        ("assign_batches_documents", assign_batches_documents),
        ("ingest_documents", ingest_documents),
        ("ingest_csv_documents", ingest_csv_documents),
    ]
    timings: dict[str, float] = {}
    for name, fn in plan:
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "total_wall_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
