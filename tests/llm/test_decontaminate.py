import hashlib
import random
import re

from opinio.llm import decontaminate
from opinio.llm.decontaminate import drop_contaminated, match_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    """The contract's result, by comparing every window with every place."""
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            size = min(window, len(v))
            for i in range(len(v) - size + 1) if size else ():
                for j in range(len(w) - size + 1):
                    if w[j : j + size] == v[i : i + size]:
                        hit.update(range(j, j + size))
                        found.add(str(item_id))
        listed = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus(seed, window=4):
    rng = random.Random(seed)
    some = ["the", "Of", "é1", "x", "y", "zz"]
    text = lambda n: " ".join(rng.choice(some) + rng.choice(["", ".", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.randint(0, 9))) for i in range(12)] + [(3, "the the"), (99, "...")]
    docs = [(i, text(rng.choice([0, 3, 30, 200]))) for i in range(40)]
    docs += [(100 + i, text(5) + " q " + items[i][1].upper().replace("É", "é") + " q " + text(4)) for i in range(8)]
    return docs + docs[:3] + [(None, items[5][1]), (7, None)], items


def run(spark, docs, items, window):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = match_documents(d, b, window).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_equals_the_plain_comparison(spark):
    for seed, window in ((1, 4), (2, 6), (3, 2)):
        docs, items = corpus(seed)
        assert run(spark, docs, items, window) == plain(docs, items, window)


def test_benchmark_in_several_blocks_and_small_shards(spark, monkeypatch):
    docs, items = corpus(5)
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 60)
    assert run(spark, docs, items, 4) == plain(docs, items, 4)


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c"), (2, None)], "item_id long, text string")
    assert match_documents(none, items).count() == 0
    docs = spark.createDataFrame([(1, "x a b c", 5, b"q"), (2, "x a b", 6, None), (3, None, 7, None)], "doc_id long, text string, n_hit int, hit binary")
    clean = match_documents(docs, items.limit(0)).collect()
    assert [r.contaminated for r in clean] == [False] * 3
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_longest_match_and_place(spark):
    items = spark.createDataFrame([(7, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zero zero two three four five zero")], "doc_id long, text string")
    r = match_documents(docs, items, window=3).first()
    assert (r.longest_words, r.longest_item, r.longest_at, r.n_hit) == (4, "7", 2, 4)
