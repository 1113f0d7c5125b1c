import random

import numpy as np
import pyarrow as pa

from opinio.llm import toxicity
from opinio.llm.common import utf8
from opinio.llm.toxicity import Network, fit, read_words, score, windows


def corpus(seed, n):
    rng = random.Random(seed)
    clean = ["the", "of", "thing", "ander", "reth", "inost", "ea", "élan"]
    bad = ["grotzen", "grotzal", "vilex"]
    out = []
    for i in range(n):
        w = rng.choices(clean, k=rng.choice([5, 60, 300]))
        if i % 3 == 0:
            w[rng.randrange(len(w))] = rng.choice(bad) if seed == 1 else rng.choice([*bad, "grotzmu"])
        out.append((i, " ".join(w), int(i % 3 == 0)))
    return out


def test_gradients_are_those_of_the_loss():
    net = Network(3)
    data, offsets = utf8(pa.array(["a bb ccc dddd a bb", "x yy zzz"]))
    w = read_words(data, offsets)
    first, size, _ = windows(w.counts)
    places = w.places[np.minimum(first + np.arange(size.max())[:, None], len(w.places) - 1)]
    for k in net.dense:
        net.dense[k] = net.dense[k].astype(np.float64)

    def logits():
        x, _, _ = net.inputs(w)
        return net.forward(x.astype(np.float64) @ net.dense["x"] + net.dense["b"], places, size, keep=True)

    weights = np.array([0.7, -1.3])
    _, state = logits()
    g, dgates = net.gradients(weights, places, state)
    for k in ("u", "a", "v", "o", "c"):
        flat = net.dense[k].reshape(-1)
        for i in (0, flat.size // 2, flat.size - 1):
            old = flat[i]
            flat[i] = old + 1e-5
            up = weights @ logits()[0]
            flat[i] = old - 1e-5
            down = weights @ logits()[0]
            flat[i] = old
            assert abs((up - down) / 2e-5 - g[k].reshape(-1)[i]) < 2e-3
    db = dgates.sum(axis=(0, 2))
    old = net.dense["b"][1, 0, 5]
    net.dense["b"][1, 0, 5] = old + 1e-5
    up = weights @ logits()[0]
    net.dense["b"][1, 0, 5] = old - 1e-5
    assert abs((up - weights @ logits()[0]) / 2e-5 - db[1, 5]) < 2e-3


def test_windows_overlap_and_cover():
    counts = np.array([0, 0, 1, 64, 300, 300 + 20_000])
    counts = np.cumsum(np.diff(counts, prepend=0))
    first, size, text = windows(counts)
    for i in range(len(counts) - 1):
        own = np.flatnonzero(text == i)
        seen = {p for k in own for p in range(first[k], first[k] + size[k])}
        assert seen == set(range(counts[i], counts[i + 1]))
        assert (np.diff(first[own]) == toxicity.STRIDE).all()


def test_learns_words_and_their_parts(spark):
    taught = spark.createDataFrame(corpus(1, 400), "doc_id long, text string, label int")
    net = fit(taught.drop("label"), taught.drop("text"))
    docs = spark.createDataFrame(corpus(2, 150), "doc_id long, text string, label int")
    got = score(docs, net).select("row.*", "score", "predicted").collect()
    assert sum(r.predicted == r.label for r in got) >= 0.95 * len(got)
    long = spark.createDataFrame([(1, "the of thing " * 20_000 + "vilex " + "ander " * 3000), (2, "the of thing " * 30_000)], "doc_id long, text string")
    assert {r.row.doc_id: r.predicted for r in score(long, net).collect()} == {1: 1, 2: 0}


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "!!"), (4, "a"), (4, "a"), (None, "b")], "doc_id long, text string").selectExpr("*", "5 as score", "6 as row")
    labelled = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, None, 0), (None, "z", 0)], "doc_id long, text string, label int")
    texts, labels = labelled.drop("label"), labelled.drop("text")
    assert fit(texts, labels) is None and fit(texts, labels.limit(0)) is None and fit(texts.limit(0), labels) is None
    assert {(r.score, r.predicted) for r in score(docs, None).select("score", "predicted").collect()} == {(0.0, 0)}
    assert score(docs, None).count() == 6
    net = Network()
    got = {r.row.doc_id: r.score for r in score(docs, net).collect()}
    assert got[1] == got[2] == got[3] == 0.0 and 0 <= got[4] <= 1
    assert score(docs.limit(0), net).count() == 0
    one = net.scores(*utf8(pa.array(["ab cd", "zz " * 100])))
    assert np.allclose(one[0], net.scores(*utf8(pa.array(["ab cd"])))[0], atol=1e-5)


def test_scores_keep_their_meaning_when_the_labels_grow(spark):
    def noisy(n):
        rng = random.Random(n)
        rows = []
        for i in range(n):
            toxic = rng.random() < 0.1
            w = rng.choices(["the", "of", "thing", "ander", "reth"], k=12)
            if rng.random() < (0.6 if toxic else 0.05):  # a sign that is often wrong, so that scores are no 0 or 1
                w[rng.randrange(12)] = "vilex"
            rows.append((i, " ".join(w), int(toxic)))
        return spark.createDataFrame(rows, "doc_id long, text string, label int")

    unseen = noisy(2001)
    means = []
    for n in (600, 6000):
        taught = noisy(n)
        net = fit(taught.drop("label"), taught.drop("text"), sample_rows=400)
        means.append(np.mean([r.score for r in score(unseen, net).select("score").collect()]))
    assert all(abs(m - 0.1) < 0.07 for m in means), means
