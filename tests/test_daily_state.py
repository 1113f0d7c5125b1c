"""Day states and view totals against full recomputation, after re-runs of random days."""

import datetime as dt
import random

from pyspark.sql import functions as F

from opinio.operators import daily_state as state
from opinio.operators.quality import quality_checks, table_stats
from opinio.operators.views import vw_sentiment_by_age, vw_sentiment_by_dept
from opinio.schemas import AGE_BANDS, PRODUCT_TABLE_SCHEMA, SENTIMENTS
from opinio.sources.sinks import write_days_parquet

DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]
MEANS = [1.0, 2.33, 4.67, 3.5, None]


def rows(rng, day):
    pick = lambda labels: rng.choice([*labels, None])
    means = [*MEANS, float("nan"), 3e15] if rng.random() < 0.4 else MEANS
    return [(pick(AGE_BANDS), pick(("D", "E")), pick(SENTIMENTS), rng.choice([1, 5, None]), rng.choice(means), day) for _ in range(rng.randint(0, 9))]


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_states_and_totals_equal_recomputation_after_reruns_of_random_days(spark, workdir):
    rng = random.Random(5)
    frame = lambda found: spark.createDataFrame(found, PRODUCT_TABLE_SCHEMA)
    product, root = f"{workdir}/product", f"{workdir}/states"
    assert same(state.merged_stats(state.stored_states(spark, root)), table_stats(frame([])))
    views = {("age_band", "sentiment"): vw_sentiment_by_age, ("department_name", "sentiment"): vw_sentiment_by_dept}
    totals = {keys: state.view_totals(frame([]), list(keys)) for keys in views}
    for step in range(4):
        days = rng.sample(DAYS, rng.randint(1, 4))
        old = frame(state.product_days(spark, product, days, PRODUCT_TABLE_SCHEMA).collect())
        write_days_parquet(frame([r for d in days for r in rows(rng, d)]), product, days, repartition_by_day=True)
        new = state.product_days(spark, product, days, PRODUCT_TABLE_SCHEMA)
        state.replace_states(new, root, days)
        now = spark.read.schema(PRODUCT_TABLE_SCHEMA).parquet(product)
        stats = state.merged_stats(state.stored_states(spark, root))
        assert same(stats, table_stats(now))
        assert same(quality_checks(None, 5, "2024-01-01", stats=stats), quality_checks(now, 5, "2024-01-01"))
        for keys, view in views.items():
            state.after_rerun(totals[keys], old, new, list(keys)).write.parquet(f"{workdir}/totals/{keys[0]}/{step}")
            totals[keys] = spark.read.parquet(f"{workdir}/totals/{keys[0]}/{step}")
            assert same(state.view_of_totals(totals[keys], now, list(keys)), view(now))


def test_report_from_states_reads_states_only(spark, workdir):
    product = spark.createDataFrame([("Jovem", "D", "Neutro", 1, 3.0, d) for d in DAYS], PRODUCT_TABLE_SCHEMA)
    state.replace_states(product, f"{workdir}/states", DAYS)
    checks = quality_checks(None, 5, "2024-01-01", stats=state.merged_stats(state.stored_states(spark, f"{workdir}/states")))
    files = checks._jdf.queryExecution().optimizedPlan().toString()
    assert "avg_rating" not in files and {r.status for r in checks.where(F.col("check_id").isin(1, 4, 5, 6)).collect()} == {"PASS"}
