import itertools
import os
import sys
import tempfile
from decimal import ROUND_HALF_UP, Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opinio.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "opinio-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="opinio-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from opinio.sources.storage import scratch_path

    return scratch_path(spark, "test")


def edge_rows():
    """Raw reviews at every band edge and one beside it, with every rating and
    recommendation; texts, departments and numbers vary by position."""
    rows = []
    ages = [str(edge + d) for edge in (18, 30, 45, 60) for d in (-1, 0, 1)] + ["n/a", None]
    for i, (age, rating, recommended) in enumerate(itertools.product(ages, range(0, 7), (0, 1, 2))):
        text = [f"text {i}", "", "  ", None, f"more {i}"][i % 5]
        department = ["North", "South", None, "East, West"][i % 4]
        rows.append((str(i), age, f"t{i}", text, str(rating), str(recommended), "D", department, "C"))
    return rows


def edge_reviews(spark):
    from opinio.schemas import RAW_HEADERS

    return spark.createDataFrame(edge_rows(), ", ".join(f"`{h}` string" for h in RAW_HEADERS))


def edge_product():
    """The product of ``edge_rows`` by the stated rules: (band, department, label) -> (reviews, mean)."""
    cells = {}
    for _, age, _, text, rating, recommended, _, department, _ in edge_rows():
        years = int(age) if age and age.isdigit() else 0
        band = next((name for low, name in ((60, "Sênior"), (45, "Madura"), (30, "Adulto"), (18, "Jovem")) if years >= low), None)
        if not (text or "").strip(" ") or band is None or department is None:
            continue
        stars = int(rating)
        label = "Positivo" if stars >= 4 and recommended == "1" else "Neutro" if stars == 3 else "Negativo"
        cells.setdefault((band, department, label), []).append(stars)
    mean = lambda v: float((Decimal(sum(v)) / len(v)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    return {k: (len(v), mean(v)) for k, v in cells.items()}


SF01 = "/root/testdata/sf0.01"
