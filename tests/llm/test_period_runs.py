import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinio.llm.period_runs import Factors, Wavelet, find_runs, periodic_runs
from opinio.llm.queries import op12_period_runs
from tests.conftest import SF001


def brute(words):
    """Maximal stretches of every period, the least period of each stretch, by the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < n - q:
            j = i
            while j < n - q and same[j]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def own_runs(words):
    symbols = np.unique(np.array(list(words)), return_inverse=True)[1]
    return list(zip(*(x.tolist() for x in find_runs(symbols, len(words))), strict=True))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text("ab", min_size=1, max_size=120), st.text("abc", min_size=1, max_size=80),
                 st.lists(st.tuples(st.text("ab", min_size=1, max_size=7), st.integers(1, 9)), min_size=1, max_size=5).map(lambda x: "".join(a * n for a, n in x)),
                 st.tuples(st.lists(st.tuples(st.text("ab", min_size=1, max_size=3), st.integers(1, 9)), min_size=1, max_size=3), st.integers(3, 6))
                 .map(lambda x: "".join(a * n for a, n in x[0]) * x[1])))
def test_runs_as_by_definition(words):
    assert own_runs(words) == brute(words)


@pytest.mark.parametrize("words", ["a" * 5, "a" * 6, "a" * 5000, "ab" * 700 + "a", "aab" * 4, ("a" * 31 + "b") * 9, ("ab" * 20 + "c") * 4, "abcdefgh" * 4 + "abc", "x"])
def test_edges(words):
    assert own_runs(words) == brute(words)


def test_fibonacci_words_and_larger_alphabets():
    a, b = "a", "ab"
    for _ in range(12):
        a, b = b, b + a
    assert own_runs(b) == brute(b)
    rng = np.random.default_rng(4)
    for size in (2, 3, 5):
        words = "".join(chr(97 + int(c)) for c in rng.integers(0, size, 1500))
        assert own_runs(words) == brute(words)


def test_wavelet_and_factor_names():
    rng = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 500):
        values = rng.permutation(n)
        tree = Wavelet(values)
        first = rng.integers(0, n + 1, 300)
        last = np.maximum(first, rng.integers(0, n + 1, 300))
        least = rng.integers(0, n + 3, 300)
        want = [min([v for v in values[a:b] if v >= c], default=n) for a, b, c in zip(first, last, least, strict=True)]
        assert tree.successor(first, last, least).tolist() == want
    text = rng.integers(0, 2, 200)
    f = Factors(text, 64)
    suffixes = sorted(range(200), key=lambda i: text[i : i + 64].tolist())
    assert [text[i : i + 64].tolist() for i in f.order] == [text[i : i + 64].tolist() for i in suffixes]


def expected(doc_id, text, planted=True):
    words = text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if planted and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(collapse(words, runs))))


def test_query_against_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").where("length(text) < 1500").collect()]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a " * 50), (1004, "a b  a b \na b  a b  a"), (1003, "x y " * 30 + "z " * 7)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_period_runs(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(i, t or "") for i, t in rows), key=repr)
    assert sum(r[1] for r in got.select("doc_id", "n_runs").collect()) > 20


def test_operator_keeps_texts_nulls_repeats_and_other_columns(spark):
    long = "u v w " * 40_000
    rows = [(1, "a a a a a a b", 5), (None, None, 6), (1, "a a a a a a b", 5), (2, long, 7), (3, "p q", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").coalesce(1)
    got = sorted(periodic_runs(docs, keep=(docs["runs"],)).collect(), key=lambda r: (r.row.doc_id or 0, r.n_words))
    assert [(r.row.doc_id, r.row.runs, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (None, 6, 0, [], ""), (1, 5, 7, [(0, 6, 1)], "a b"), (1, 5, 7, [(0, 6, 1)], "a b"), (2, 7, 120_000, [(0, 120_000, 3)], "u v w"), (3, 8, 2, [], "p q")
    ]
    assert periodic_runs(docs.limit(0)).count() == 0
