"""Physical-plan properties the design relies on (checked with explain output)."""

import re

from pyspark.sql import functions as F

from opinio.operators.aggregate import product
from opinio.operators.batching import assign_batches
from opinio.operators.clean import clean
from opinio.operators.quality import quality_checks
from opinio.plans import derived
from opinio.sources.files import trusted_scan
from opinio.sources.sinks import write_days_parquet
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _trusted(spark, workdir):
    t = clean(derived.event_reviews(spark, SF001))
    days = [r[0].isoformat() for r in t.select("dt").distinct().collect()]
    write_days_parquet(t, workdir + "/trusted", days)
    return trusted_scan(spark, workdir + "/trusted", days=days[:3])


def test_product_plan_is_one_shuffle_with_pushdown(spark, workdir):
    plan = _plan(product(_trusted(spark, workdir)))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_count" in plan and "partial_avg" in plan  # map-side combine before the shuffle
    assert "isnotnull(age_band" in plan.lower()  # key filter pushed to the scan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "review_text" not in scan and "clothing_id" not in scan  # pruned columns


def test_batching_moves_rows_once(spark):
    docs = derived.table(spark, SF001, "documents")
    plan = _plan(assign_batches(docs, "doc_id"))
    # the rows' one (range) shuffle is inside the persisted frame that counts and rows share
    cuts = set(re.findall(r"Exchange (rangepartitioning\([^)]*\)), REPARTITION_BY_NUM", plan))
    assert len(cuts) == 1 and "rangepartitioning" not in plan.split("InMemoryRelation")[0]
    assert "BroadcastExchange" in plan and "hashpartitioning(doc_id" not in plan


def test_quality_checks_scan_once(spark, workdir):
    plan = _plan(quality_checks(product(_trusted(spark, workdir)), 3, "2024-01-01"))
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_views_group_small_product(spark, workdir):
    from opinio.operators.views import vw_sentiment_by_age

    p = product(_trusted(spark, workdir))
    out = vw_sentiment_by_age(p)
    assert dict(out.dtypes) == {"age_band": "string", "sentiment": "string", "total_reviews": "bigint", "media_nota": "double"}
    assert out.where(F.col("media_nota").isNull()).count() == 0
