"""Skewed inputs: one value holding a third of the rows or more."""

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinio.operators.aggregate import product
from opinio.operators.batching import _RANGE, placed_rows, with_row_index
from opinio.operators.clean import clean


def _order(row):  # ascending, nulls first
    return tuple((x is not None, x if x is not None else 0) for x in row)


def _largest(df, cols, ranges):
    return max(r["count"] for r in placed_rows(df, cols, ranges).groupBy(_RANGE).count().collect())


@pytest.mark.parametrize("cols", [["k"], ["k", "s"], ["k", "two", "id"], ["k", "id"], ["s"], ["two"]])
def test_no_task_holds_much_more_than_its_share(spark, cols):
    """Half the rows have one lead value; strings share a long prefix; one column has two values."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.concat(F.lit("a-common-prefix-"), F.format_string("%08d", "id")).alias("s"),
        (F.col("id") % 3 % 2).alias("two"),
        "id",
    )
    assert _largest(rows, cols, 32) <= 2.5 * 60_000 / 32
    got = with_row_index(rows, cols, num_ranges=32).orderBy("row_index").select("row_index", *cols).collect()
    assert [r.row_index for r in got] == list(range(60_000))
    keys = [tuple(r[c] for c in cols) for r in got]
    assert keys == sorted(keys)


def test_row_index_of_a_real_table(spark):
    import duckdb

    path = "/root/testdata/sf0.01/lineitem.parquet"
    items = spark.read.parquet(path).select("l_orderkey", "l_linenumber")
    cols = ["l_linenumber", "l_orderkey"]
    assert _largest(items, cols, 32) <= 2.5 * items.count() / 32
    got = {(r.l_orderkey, r.l_linenumber): r.row_index for r in with_row_index(items, cols, num_ranges=32).collect()}
    expected = duckdb.sql(
        f"SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_linenumber, l_orderkey) - 1 "
        f"FROM read_parquet('{path}')"
    ).fetchall()
    assert got == {(k, n): i for k, n, i in expected}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    leads=st.lists(st.one_of(st.sampled_from([7, 7, 7, -3, 0, 2**60, 2**60 + 1]), st.integers(-50, 50), st.none()), min_size=1, max_size=300),
    ranges=st.integers(1, 9),
)
def test_row_index_matches_python_sort(spark, leads, ranges):
    """Duplicated (hot), negative, very large and null leads; a unique tie column makes the order total."""
    rows = [(k, i * 7919 % 100_003) for i, k in enumerate(leads)]
    df = spark.createDataFrame(rows, "k long, t long")
    got = {(r.k, r.t): r.row_index for r in with_row_index(df, ["k", "t"], num_ranges=ranges).collect()}
    assert got == {kt: i for i, kt in enumerate(sorted(rows, key=_order))}


def test_many_more_ranges_than_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id")
    got = [r.row_index for r in with_row_index(docs, ["doc_id"], num_ranges=500).orderBy("doc_id").collect()]
    assert got == list(range(docs.count()))


def test_hot_department_product_matches_brute_force(spark):
    rows = []
    for i in range(3000):
        dept = "Hot" if i % 3 == 0 else f"D{i % 7}"
        rows.append((f"r{i}", str(18 + i % 50), str(1 + i % 5), str(i % 2), dept))
    schema = "review_text string, age string, rating string, recommended_ind string, department_name string"
    out = product(clean(spark.createDataFrame(rows, schema)))
    got = {(r.age_band, r.department_name, r.sentiment): (r.review_count, r.avg_rating) for r in out.collect()}

    def band(a):
        return "Jovem" if a < 30 else "Adulto" if a < 45 else "Madura" if a < 60 else "Sênior"

    def sent(r, c):
        return "Positivo" if r >= 4 and c == 1 else "Neutro" if r == 3 else "Negativo"

    counts, sums = Counter(), defaultdict(int)
    for _, a, r, c, d in rows:
        key = (band(int(a)), d, sent(int(r), int(c)))
        counts[key] += 1
        sums[key] += int(r)
    from decimal import ROUND_HALF_UP, Decimal

    expected = {
        k: (n, float((Decimal(sums[k]) / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)))
        for k, n in counts.items()
    }
    assert got == expected
    assert sum(n for (b, d, s), (n, _) in got.items() if d == "Hot") == 1000
