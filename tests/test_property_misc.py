"""Property tests: the views' exact mean of means, the checks, header names."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from opinio.operators.views import vw_sentiment_by_age

_SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@_SETTINGS
@given(cells=st.lists(st.tuples(st.sampled_from(["Jovem", "Adulto"]), st.integers(100, 500)), min_size=1, max_size=80))
def test_mean_of_means_is_exact_half_up(spark, cells):
    rows = [(band, "Positivo", 1, cents / 100) for band, cents in cells]
    product = spark.createDataFrame(rows, "age_band string, sentiment string, review_count int, avg_rating double")
    got = {r.age_band: r.media_nota for r in vw_sentiment_by_age(product).collect()}
    for band in {b for b, _ in cells}:
        cents = [c for b, c in cells if b == band]
        mean = Decimal(sum(cents)) / Decimal(100 * len(cents))
        assert got[band] == float(mean.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)), (band, cents)


@pytest.mark.parametrize("cells", [[3.0, 1e9], [2e8], [1e13, 2.5], [2e14, 4.0], [2e14, 6e14], [1e300]])
def test_large_cell_means_equal_the_plain_mean(spark, cells):
    product = spark.createDataFrame([("Jovem", "Neutro", 1, c) for c in cells], "age_band string, sentiment string, review_count int, avg_rating double")
    assert vw_sentiment_by_age(product).first().media_nota == round(sum(cells) / len(cells), 2)


_band = st.sampled_from(["Jovem", "Adulto", "Madura", "Sênior", "Outro"]) | st.none()
_sent = st.sampled_from(["Positivo", "Neutro", "Negativo"]) | st.none()


@_SETTINGS
@given(
    rows=st.lists(st.tuples(_band, _sent, st.integers(0, 6)), min_size=1, max_size=60),
    n_exp=st.integers(1, 8),
)
def test_quality_checks_match_model(spark, rows, n_exp):
    import datetime as dt

    from opinio.operators.quality import quality_checks

    day0 = dt.date(2024, 1, 1)
    data = [(b, "D", s, 1, 3.0, day0 + dt.timedelta(days=d)) for b, s, d in rows]
    schema = "age_band string, department_name string, sentiment string, review_count int, avg_rating double, dt date"
    got = {r.check_id: r for r in quality_checks(spark.createDataFrame(data, schema), n_exp, "2024-01-01").collect()}

    days = {d for _, _, d in rows}
    bands = sorted({b for b, _, _ in rows if b is not None})
    sents = sorted({s for _, s, _ in rows if s is not None})
    lo, hi = day0 + dt.timedelta(days=min(days)), day0 + dt.timedelta(days=max(days))
    max_exp = day0 + dt.timedelta(days=n_exp - 1)
    expected = {
        1: (len(days) == n_exp, str(len(days)), f"count={len(days)}"),
        2: (set(bands) == {"Jovem", "Adulto", "Madura", "Sênior"}, ",".join(bands), f"values={bands}"),
        3: (set(sents) == {"Positivo", "Neutro", "Negativo"}, ",".join(sents), f"values={sents}"),
        4: (all(b is not None for b, _, _ in rows), str(sum(b is None for b, _, _ in rows)), None),
        5: (all(s is not None for _, s, _ in rows), str(sum(s is None for _, s, _ in rows)), None),
        6: (lo == day0 and hi == max_exp, f"{lo}..{hi}", f"min={lo} max={hi}"),
    }
    for cid, (ok, actual, detail) in expected.items():
        r = got[cid]
        assert r.status == ("PASS" if ok else "FAIL"), (cid, r)
        assert r.actual == actual, (cid, r)
        if detail is not None:
            assert r.detail == detail, (cid, r)


@settings(max_examples=300, deadline=None)
@given(name=st.text(max_size=30))
def test_snake_case_matches_the_stated_rule(name):
    """Strip, lower, runs of non [0-9a-z] to '_', runs of '_' to one, strip '_'."""
    import re

    from opinio.functions.rules import snake_case

    stated = re.sub(r"_+", "_", re.sub(r"[^0-9a-z]+", "_", name.strip().lower())).strip("_")
    assert snake_case(name) == stated
