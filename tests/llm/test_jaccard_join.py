import random
import re

import numpy as np

from opinio.llm import jaccard_join
from opinio.llm.jaccard_join import components, intersections, link_documents, one_of_each, runs_needed

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sets(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plain(rows):
    """Links, classes and groups, by comparing all pairs."""
    s = [sets(t) for _, t in rows]
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    n = len(rows)
    near = [[j for j in range(n) if j != i and s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]) - 1e-9] for i in range(n)]
    group = list(range(n))
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        group[i] = min(seen, key=key)
    out = []
    for i in range(n):
        same = [j for j in range(n) if s[j] == s[i]] if s[i] else [i]
        out.append((rows[i][0], rows[min(same, key=key)][0], len(same), rows[group[i]][0], len(near[i])))
    return sorted(out, key=str)


def corpus(seed, n=120, words=60):
    rng = random.Random(seed)
    vocabulary = [a + b for a in "abcdefghij" for b in "uvwxyz"]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 12, words]))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", ", "]).join(w).capitalize()))
    return rows + rows[:3] + [(None, rows[4][1]), (None, "own words of no other text at all"), (500, ""), (501, None), (502, "..."), (503, "one"), (504, "ONE")]


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as t", "2 as class", "3 as n")
    return sorted((tuple(r) for r in link_documents(docs).select("doc_id", "set_id", "set_size", "class_id", "n_links").collect()), key=str)


def test_equals_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert run(spark, rows) == plain(rows)


def test_large_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "CROWD", 5)
    monkeypatch.setattr(jaccard_join, "DEPTH", 2)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):  # near copies of one text, all different
        w = list(base)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, t) for i, t in enumerate(x for _, x in corpus(3, 60))]
    assert run(spark, rows) == plain(rows)


def test_one_document_of_each_group_stays(spark):
    rows = corpus(4, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as row", "8 as id")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id) for r in kept.collect()))
    want = plain(rows)
    empty = [str(i) for i, t in rows if not sets(t)]
    assert got == sorted([str(g) for g in {w[3] for w in want if str(w[0]) not in empty}] + empty)
    assert one_of_each(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    pairs = [(bytes([i]), bytes([i + 1])) for i in range(0, 60)] + [(b"\xf0", b"\xf1")]
    random.Random(1).shuffle(pairs)
    got = {bytes(r.key): bytes(r.label) for r in components(spark.createDataFrame(pairs, "a binary, b binary")).collect()}
    assert got == {**{bytes([i]): b"\x00" for i in range(61)}, b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


def test_intersections_and_runs():
    rng = np.random.default_rng(2)
    some = [np.unique(rng.integers(0, 50, rng.integers(1, 40))).astype(np.uint64) for _ in range(12)]
    every = np.arange(12)
    want = np.array([[len(np.intersect1d(x, y)) for y in some] for x in some])
    other = ~np.eye(12, dtype=bool)  # what a set shares with none is left out, also from itself
    assert (intersections(some, every, every) == want)[other].all()
    assert (intersections(some, every[:2], every[2:5]) == want[:2, 2:5]).all()
    assert runs_needed(0.999, 4) == 19 and runs_needed(0.9, 1) == 3
