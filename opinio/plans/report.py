"""The quality report - one scan, six checks, a summary, a JSON sink.

A failing scan (missing table, an unreadable column) does not abort the report:
the checks are then run one by one, and those that fail on their own become
FAIL rows that carry the whole error and keep their expectation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.operators.quality import CHECK_NAMES, quality_checks, quality_summary
from opinio.sources.sinks import write_report


def run_quality_report(
    spark: SparkSession,
    load_product,
    report_path: str | None = None,
    target: str = "customer_sentiment.customer_sentiment_by_age",
    **expectations,
) -> tuple[DataFrame, dict | None, int]:
    """Returns (checks, report document or None, exit code)."""

    def run(only: tuple[int, ...]) -> list:
        return quality_checks(load_product(), only=only, **expectations).collect()

    def run_alone(check_id: int) -> list:
        try:
            return run((check_id,))
        except Exception as exc:  # the report's subject: recorded whole in its row
            text = F.lit(f"{type(exc).__name__}: {exc}")
            return quality_checks(None, only=(check_id,), error=text, spark=spark, **expectations).collect()

    ids = tuple(cid for cid, _ in CHECK_NAMES)
    try:
        rows = run(ids)
    except Exception:  # each check then tells its own error
        rows = [r for cid in ids for r in run_alone(cid)]
    checks = spark.createDataFrame(rows, "check_id int, name string, status string, expected string, actual string, detail string")
    summary = quality_summary(checks)
    doc = write_report(checks, summary, report_path, target) if report_path else None
    failed = summary.first()["fail_count"]
    return checks, doc, 1 if failed else 0
