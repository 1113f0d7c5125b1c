"""Write PLANS.md: final physical plans of the main jobs (sf0.01 inputs, run first).

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opinio.operators import quality, views  # noqa: E402
from opinio.operators.aggregate import product  # noqa: E402
from opinio.operators.batching import assign_batches, with_row_index  # noqa: E402
from opinio.operators.clean import clean  # noqa: E402
from opinio.plans import derived  # noqa: E402
from opinio.plans.ingest import plan_ingest  # noqa: E402
from opinio.session import build_session  # noqa: E402
from opinio.sources.files import trusted_scan  # noqa: E402
from opinio.sources.sinks import write_days_parquet  # noqa: E402
from opinio.sources.storage import scratch_path  # noqa: E402


def formatted(df) -> str:
    """The final adaptive plan: the query is run first (small sf0.01 results),
    so the plan shows its codegen stages and AQE's shuffle reads."""
    df.collect()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("+- == Initial Plan ==")[0].strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[2]", shuffle_partitions=8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="opinio-plans-")})
    root = scratch_path(spark, "plans")
    trusted = clean(derived.event_reviews(spark, sf_dir))
    days = [r[0].isoformat() for r in trusted.select("dt").distinct().collect()]
    write_days_parquet(trusted, f"{root}/trusted", days)
    tr = trusted_scan(spark, f"{root}/trusted", days=days)
    prod = product(tr)
    sections = [
        ("D1 clean (raw reviews -> trusted rows)", clean(derived.event_reviews(spark, sf_dir))),
        ("D2 product from the trusted layer (all days)", prod),
        ("A4 vw_sentiment_by_age over the product", views.vw_sentiment_by_age(prod)),
        ("D6 six quality checks in one scan", quality.quality_checks(prod, len(days), min(days))),
        ("W1 global row numbering of documents", assign_batches(derived.table(spark, sf_dir, "documents"), "doc_id")),
        (
            "D4 ingest: rows still to write on a first run (documents, 100-row batches)",
            plan_ingest(spark, derived.table(spark, sf_dir, "documents"), f"{root}/ingest-raw", lambda rows: with_row_index(rows, "doc_id"))[2],
        ),
    ]
    out = [
        "# Physical plans of the main jobs",
        "",
        f"Generated by `scripts/show_plans.py` on `{sf_dir}`: each query is run, then its final adaptive plan",
        "is printed (the tree only, its initial form left out).",
        "",
    ]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
