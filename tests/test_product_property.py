"""Clean + product on generated raw rows against a brute-force model of the jobs."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from opinio.operators.aggregate import product
from opinio.operators.clean import clean

_text = st.sampled_from(["", " ", "   ", "\t", "\n", " \t ", "ok", " good ", "x\ny"]) | st.none()
_age = st.sampled_from(["17", "18", "29", "29.9", "30", " 44 ", "45", "59", "60", "85", "abc", "", "1e2", "-5"]) | st.none()
_rating = st.sampled_from(["1", "2", "3", "4", "5", "3.5", "4.5", "junk", ""]) | st.none()
_rec = st.sampled_from(["0", "1", "1.0", "2", "x"]) | st.none()
_dept = st.sampled_from(["Tops", "Dresses", "Hot"]) | st.none()
_row = st.tuples(_text, _age, _rating, _rec, _dept)


def _py_int(v):
    try:
        return None if v is None else int(float(v))
    except ValueError:
        return None


def _band(age):
    a = _py_int(age)
    if a is None:
        return None
    for lo, hi, name in ((18, 29, "Jovem"), (30, 44, "Adulto"), (45, 59, "Madura")):
        if lo <= a <= hi:
            return name
    return "Sênior" if a >= 60 else None


def _sentiment(rating, rec):
    r, c = _py_int(rating), _py_int(rec)
    if r is not None and r >= 4 and c == 1:
        return "Positivo"
    return "Neutro" if r == 3 else "Negativo"


def _cast_double(v):
    """Spark's cast of these rating texts (plain decimals; junk and blanks are null)."""
    try:
        return float(v) if v not in (None, "") and v.strip() == v else None
    except ValueError:
        return None


def expected_product(rows):
    groups = defaultdict(list)
    for text, age, rating, rec, dept in rows:
        if text is None or len(text.strip(" ")) == 0:  # Spark trim: spaces only
            continue
        band = _band(age)
        if band is None or dept is None:
            continue
        groups[(band, dept, _sentiment(rating, rec))].append(_cast_double(rating))
    out = {}
    for key, values in groups.items():
        nums = [v for v in values if v is not None]
        mean = None
        if nums:
            m = sum(nums) / len(nums)
            mean = float(Decimal(repr(m)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        out[key] = (len(values), mean)
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_row, min_size=1, max_size=200))
def test_product_matches_model(spark, rows):
    schema = "review_text string, age string, rating string, recommended_ind string, department_name string"
    got = {
        (r.age_band, r.department_name, r.sentiment): (r.review_count, r.avg_rating)
        for r in product(clean(spark.createDataFrame(rows, schema))).collect()
    }
    assert got == expected_product(rows)
