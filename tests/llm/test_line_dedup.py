import random
import re

import numpy as np
import pyarrow as pa

from opinio.llm.line_dedup import _merge_spans, _runs, cut, dedup_lines, least

WORD = re.compile("[^ \t-\r]+")


def plain(rows, size):
    """Words that stay, by comparing every run with every earlier one."""
    docs = sorted({(i is None, i or 0, t or "") for i, t in rows})
    first, by_text, kept = {}, {}, {}
    for none, i, t in docs:
        by_text.setdefault(t, (none, i))
        w = WORD.findall(t)
        if by_text[t] == (none, i):
            for p in range(len(w) - size + 1):
                first.setdefault(tuple(w[p : p + size]), (none, i, p))
    for none, i, t in docs:
        w = WORD.findall(t)
        stays = [True] * len(w)
        if by_text[t] != (none, i):
            stays = [len(w) < size] * len(w)
        else:
            for p in range(len(w) - size + 1):
                f = first[tuple(w[p : p + size])]
                if f != (none, i, p):
                    begin = max(p, f[2] + size) if f[:2] == (none, i) else p
                    stays[begin : p + size] = [False] * (p + size - begin)
        kept[(none, i, t)] = [x for x, s in zip(w, stays, strict=True) if s]
    return sorted((str(i), kept[(i is None, i or 0, t or "")]) for i, t in rows)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyé")
    some = [[word() for _ in range(rng.randint(6, 14))] for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [[word() for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(0, 4))]
        parts += rng.choices(some, k=rng.choice([0, 0, 1, 2]))
        rng.shuffle(parts)
        rows.append((i, "".join(w + rng.choice([" ", "  ", "\n", "\t"]) for p in parts for w in p)))
    rows += [(100 + i, rows[i][1]) for i in range(0, 20, 3)] + rows[:2] + [(None, rows[5][1]), (-1, None), (200, ""), (201, "ax " * 40), (202, "bx cy " * 30)]
    rng.shuffle(rows)
    return rows


def run(spark, rows, size, line):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as t", "2 as g", "3 as copy")
    return dedup_lines(docs, min_words=size, line=line, keep=("t",)).collect()


def test_equals_the_plain_comparison(spark):
    for seed, size, line in ((1, 5, 2), (2, 6, 3), (3, 5, 5), (4, 7, 1)):
        rows = corpus(seed)
        got = run(spark, rows, size, line)
        assert sorted((str(r.row.doc_id), WORD.findall(r.text)) for r in got) == plain(rows, size)
        for r in got:
            assert r.n_words - r.n_removed == len(WORD.findall(r.text))
            assert (r.n_removed > 0) == bool(r.runs)


def test_runs_name_what_they_repeat(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(1, "p q " + " ".join(w)), (2, "x\n" + " ".join(w[5:]) + "\ny z")]
    got = {r.row.doc_id: r for r in run(spark, rows, 50, 8)}
    assert got[1].text == rows[0][1] and not got[1].runs
    assert got[2].text == "x\ny z"
    assert [tuple(x) for x in got[2].runs] == [(1, 55, 1)]


def test_hot_passage_and_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"own{i} begin{i} {passage} end{i}") for i in range(300)] + [(1000, "long words " * 30_000)]
    got = run(spark, rows, 50, 8)
    assert sum(len(WORD.findall(r.text)) for r in got if r.row.doc_id < 1000) == 300 * 3 + 55
    assert [r.n_words - r.n_removed for r in got if r.row.doc_id == 1000] == [50]


def test_repeated_words_in_several_documents(spark):
    rows = [(4, "ax by " * 20), (2, "z " + "by ax " * 15 + "q"), (3, "ax " * 30), (6, "cc " + "ax " * 25), (None, "ax by " * 10 + "w"), (5, "m n o p q r " * 3 + "x " + "m n o p q r " * 2)]
    for size, line in ((5, 2), (8, 3), (50, 16)):
        got = run(spark, rows, size, line)
        assert sorted((str(r.row.doc_id), WORD.findall(r.text)) for r in got) == plain(rows, size)


def test_a_run_stands_once_for_a_text():
    text = "ax " * 5000 + "p q " * 500
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([1]), pa.array([text]), pa.array([list(range(6000))], pa.list_(pa.int32()))], ["id", "t", "text", "at"])
    (out,) = _runs(5, 2, iter([batch]))
    rows = out.to_pylist()
    assert len({r["g"] for r in rows}) == len(rows) < 10
    first = next(r for r in rows if r["at"] == 0)
    assert [(x >> 32, x & 0xFFFFFFFF) for x in first["others"]] == [(1, 5000)]


def test_spans_of_a_text_are_merged():
    span = lambda a, b: {"span": (a << 32) + b, "source": a}
    lists = [[span(30, 35), span(1, 6), span(4, 9), span(9, 14)], [span(2, 7)]]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([None, 5]), pa.array(lists)], ["rt", "rid", "repeats"])
    (out,) = _merge_spans(iter([batch]))
    assert out.column("repeats").to_pylist() == [[span(1, 14), span(30, 35)], [span(2, 7)]]
    assert out.column("rid").to_pylist() == [None, 5]


def test_least_of_every_window():
    rng = np.random.default_rng(0)
    places = np.arange(120)
    for width in (1, 2, 3, 5, 8, 43):
        h = rng.integers(0, 9, 120).astype(np.uint64)
        start, chosen = least(h, places, places, width)
        assert chosen.tolist() == [min(range(i, i + width), key=lambda k: (h[k], k % width)) for i in start.tolist()]
        assert len(start) == 120 - width + 1
    _, chosen = least(np.zeros(1000, np.uint64), np.arange(1000), np.arange(1000), 35)
    assert len(set(chosen.tolist())) <= 1000 // 35 + 1


def test_cut_white_space():
    text = b"  a b\nc d  "
    starts, ends = np.array([2, 4, 6, 8]), np.array([3, 5, 7, 9])
    say = lambda *k: cut(text, starts, ends, np.array(k, bool))
    assert say(1, 1, 1, 1) == text
    assert say(1, 0, 1, 1) == b"  a\nc d  "
    assert say(0, 1, 1, 0) == b"b\nc"
    assert say(0, 0, 0, 0) == b""
    assert say(1, 0, 0, 1) == b"  a d  "


def test_no_rows(spark):
    assert run(spark, [(1, "a")], 5, 2)[0].text == "a"
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
