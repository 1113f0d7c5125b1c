import hashlib
import re

from pyspark.sql import functions as F

from opinio.llm.exact_dedup import exact_groups


def plain(rows):
    norm = lambda t: re.sub("[ \t-\r]", "", t or "")
    out = []
    for i, (doc_id, text) in enumerate(rows):
        same = [(-len(t or ""), d is None, d or 0, j) for j, (d, t) in enumerate(rows) if norm(t) == norm(text)]
        best = min(same)
        out.append((doc_id, rows[best[3]][0], len(same), best[3] == i, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "a b"), (3, "ab"), (9, "a\tb "), (1, "a\u00a0b"), (7, None), (2, " \n"), (4, ""), (None, "a  b "), (8, "é x"), (8, "éx "), (10, "long" * 20000), (11, "long " * 20000), (12, "z"), (12, "z")]


def test_equals_the_plain_rule(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as hash", "2 as norm", "3 as row", "4 as id").coalesce(1)
    assert sorted((tuple(r) for r in exact_groups(docs).collect()), key=str) == plain(ROWS)


def test_collisions_are_told_apart_by_bytes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)
    weak = lambda b: F.substring(F.md5(b), 1, 0)  # noqa: E731  every text collides
    assert sorted((tuple(r) for r in exact_groups(docs, content_hash=weak).collect()), key=str) == plain(ROWS)


def test_no_rows(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
