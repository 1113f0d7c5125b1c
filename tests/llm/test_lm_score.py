import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from opinio.llm import lm_score
from opinio.llm.bpe import read_ranks
from opinio.llm.lm_score import CONTEXT, STRIDE, Classes, LanguageModel, Network, Subwords, context_windows, make_classes, train_network

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = read_ranks(PATH)
SUBWORDS = Subwords(RANKS, PATTERN)


def texts(seed, n=40):
    rng = random.Random(seed)
    parts = ["tion", "er", "the", "an", "ing", "élan", "x", "Of", "42", "..."]
    return [rng.choice([" ", "\n", "\t "]).join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.choice([0, 1, 8, 60, 200]))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return LanguageModel(RANKS, PATTERN, *train_network(SUBWORDS, [t.encode() for t in texts(1, 80)], 60, batch=16))


def test_gradients_are_those_of_the_loss():
    net = Network(30, 1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net.mask = net.mask.astype(np.float64)
    rng = np.random.default_rng(0)
    ids, targets = rng.integers(0, 30, (3, 9)), rng.integers(0, 30, (3, 9))
    used = rng.random((3, 9)) < 0.8
    _, g = net.loss(ids, targets, used)
    for k, v in net.w.items():
        flat = v.reshape(-1)
        for i in rng.integers(0, flat.size, 4):
            old = flat[i]
            flat[i] = old + 1e-5
            up, _ = net.loss(ids, targets, used)
            flat[i] = old - 1e-5
            down, _ = net.loss(ids, targets, used)
            flat[i] = old
            assert abs((up - down) / 2e-5 - np.asarray(g[k]).reshape(-1)[i]) < 1e-4, k


def test_attention_is_causal(model):
    ids = np.random.default_rng(1).integers(0, 50, (1, 20))
    other = ids.copy()
    other[0, 12:] = 3
    assert np.allclose(model.network.hidden(ids)[0][0, :12], model.network.hidden(other)[0][0, :12], atol=1e-6)


def test_windows_score_each_place_once():
    size = np.array([0, 1, CONTEXT, CONTEXT + 1, 1000])
    owner, begin, scored = context_windows(size)
    for i, n in enumerate(size.tolist()):
        places = [p for k in np.flatnonzero(owner == i) for p in range(begin[k] + scored[k], min(begin[k] + CONTEXT, n))]
        assert places == list(range(n))
    assert STRIDE < CONTEXT


def plain_logs(model, text):
    """Word by word and place by place, from the definition."""
    sub, classes = model.subwords, model.classes
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    ids, first = [], []
    for w in words:
        first.append(len(ids))
        ids += sub.encoding.encode_ordinary(" " + w.decode())
    first.append(len(ids))
    ids.append(sub.end)
    shown = [classes.of[sub.end], *classes.of[ids[:-1]]]
    log_id, log_begin = [], []
    for t in range(len(ids)):
        window = 0 if t < CONTEXT else (t - CONTEXT) // STRIDE + 1
        context = np.array([shown[window * STRIDE : t + 1]])
        z = (model.network.hidden(context)[0][0, -1] @ model.network.w["y"] + model.network.w["by"]).astype(np.float64)
        p = np.exp(z - z.max())
        p /= p.sum()
        log_id.append(math.log(p[classes.of[ids[t]]]) + classes.within[ids[t]])
        log_begin.append(math.log(p[classes.begins].sum()))
    out = []
    for a, b in zip(first, [*first[1:], None], strict=True):
        out.append(sum(log_id[a:b]) - log_begin[a] + (log_begin[b] if b is not None else 0))
    return out


def test_word_logs_equal_the_definition(model):
    some = ["", "the", texts(3)[2], *[t for t in texts(4) if len(t) > 600][:2]]
    logs, words = model.word_logs([t.encode() for t in some])
    at = 0
    for text, n in zip(some, words.tolist(), strict=True):
        assert np.allclose(logs[at : at + n], plain_logs(model, text), atol=2e-3)
        at += n


def test_classes_are_distributions(model):
    c: Classes = model.classes
    assert np.allclose(np.bincount(c.of, np.exp(c.within)), 1) or (np.bincount(c.of, np.exp(c.within))[np.unique(c.of)] - 1 < 1e-9).all()
    tokens = {r: t for t, r in SUBWORDS.encoding._mergeable_ranks.items()}
    assert all(c.begins[c.of[i]] == (i == SUBWORDS.end or tokens[i][:1] == b" ") for i in range(0, SUBWORDS.end + 1, 37))
    few = make_classes(np.array([5, 5, SUBWORDS.end]), SUBWORDS.begins)
    assert (few.of >= 0).all()


def run(spark, rows, learn, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as h", "2 as at", "3 as row").coalesce(3)
    taught = docs.where(learn)
    counts = lm_score.word_counts(taught)
    frequent = lm_score.frequent_words(counts, **options)
    model = lm_score.fit(taught, counts, frequent, PATH, PATTERN, steps=5)
    return lm_score.score(docs, counts, frequent, model).collect(), model


def test_counts_and_mixture_equal_the_plain_rule(spark):
    rows = list(enumerate(texts(5))) + [(100, None), (101, "onlyhere words"), (101, "onlyhere words"), (None, "the the")]
    learn = "doc_id is not null and doc_id % 3 <> 1"
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\0end"]
    taught = [t for i, t in rows if i is not None and i % 3 != 1]
    c = Counter(w for t in taught for w in split(t))
    n, v = sum(c.values()), len(c)
    for limit in (10, 1_000_000):
        got, model = run(spark, rows, learn, limit=limit)
        assert len(got) == len(rows)
        found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 2)) for r in got)
        want = []
        for i, t in rows:
            w = split(t)
            logs, _ = model.word_logs([(t or "").encode()])
            base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
            score = sum(math.log10(model.share * c[x] / n + (1 - model.share) * math.exp(p)) for x, p in zip(w, logs, strict=True))
            want.append((str(i), len(w), sum(c[x] > 0 for x in w), n, round(base, 6), round(score, 2)))
        assert [f[:5] for f in found] == [w[:5] for w in sorted(want)]
        assert np.allclose([f[5] for f in found], [w[5] for w in sorted(want)], atol=0.05)


def test_no_rows_and_no_training_text(spark):
    assert run(spark, [(1, "a b")], "false")[0][0].n_known == 0
    assert run(spark, [], "true")[0] == []


def test_ids_that_share_a_class_are_read_apart():
    tokens = [t.strip() for t in SUBWORDS.encoding.decode_tokens_bytes(list(range(1000, 6000))) if t[:1] == b" " and t.strip().isalpha()]
    bodies = [b" ".join(random.Random(j).choices(tokens[:600], k=60)) for j in range(40)]
    classes, net = train_network(SUBWORDS, bodies, 5, batch=16)
    assert classes.own == lm_score.OWN_CLASSES == 160 and (CONTEXT, STRIDE) == (32, 24)
    ids = np.unique(SUBWORDS.texts(bodies)[0])
    shared = ids[classes.of[ids] >= classes.own]
    inputs = LanguageModel(RANKS, PATTERN, classes, net).inputs[shared]
    assert len(shared) > 20 and len(np.unique(inputs, axis=0)) > 0.8 * len(shared)


def test_every_training_text_makes_the_model(spark):
    common = "the of and"
    rows = [(i, f"{common} text{i} " * 40) for i in range(300)] + [(1000 + i, "zebra quartz " * 40 + str(i)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = lm_score.word_counts(docs)
    model = lm_score.fit(docs, counts, lm_score.frequent_words(counts), PATH, PATTERN, sample_chars=2000, steps=5)
    ids = np.concatenate([SUBWORDS.texts([t.encode()])[0] for _, t in rows])
    n = np.bincount(ids, minlength=SUBWORDS.end + 1)
    c = model.classes
    total = np.bincount(c.of, n + 0.05)
    assert np.allclose(c.within, np.log((n + 0.05) / total[c.of]))
    assert c.own == lm_score.OWN_CLASSES and n[c.of < c.own].min() >= n[c.of >= c.own].max()
    # ids that share a class are still told apart where they are read: each one trained on has an embedding of its own
    shared = np.flatnonzero((n > 0) & (c.of >= c.own))
    assert len(shared) > 20 and (np.abs(model.network.offset[shared]).max(axis=1) > 0).mean() > 0.8
    assert len(np.unique(model.inputs[shared], axis=0)) > 0.8 * len(shared)


def test_sample_counts_texts_not_copies(spark):
    rows = [(i, f"text {i % 6} " * 100) for i in range(3000)] + [(9000 + i, f"long {i} " * 4000) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    drawn = lm_score.draw_texts(docs, 10_000)
    assert sum(len(b) for _, b in drawn) >= 5000 and len({t for t, _ in drawn}) == len(drawn) >= 8
    assert len(lm_score.draw_texts(docs.where("doc_id >= 9000"), 1000)) == 4
    assert lm_score.draw_texts(docs.limit(0), 1000) == []


def test_stored_ids_are_those_of_the_texts(spark):
    rows = [(i, t) for i, t in enumerate(texts(8))] + [(98, None), (99, " \n"), (100, "日本 x\u00a0y \u3000z 42")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as t", "2 as row").coalesce(2)
    stored = lm_score.with_ids(docs, PATH, PATTERN)
    assert stored.columns == [*docs.columns, "ids"] and stored.count() == len(rows)
    table = stored.orderBy("doc_id").toArrow()
    column = table.column("ids").combine_chunks()
    for want, got in zip(SUBWORDS.texts([(t or "").encode() for _, t in sorted(rows)]), SUBWORDS.stored(column), strict=True):
        assert want.tolist() == got.tolist()
    part = column.slice(5, 9)
    assert SUBWORDS.stored(part)[0].tolist() == SUBWORDS.texts([(t or "").encode() for _, t in sorted(rows)[5:14]])[0].tolist()
    assert lm_score.with_ids(docs.limit(0), PATH, PATTERN).count() == 0
    plain, by_ids = docs.select("doc_id", "text"), stored.select("doc_id", "text", "ids")
    counts = lm_score.word_counts(plain)
    frequent = lm_score.frequent_words(counts)
    found = [lm_score.corpus_classes(x, RANKS, PATTERN, ids_col=c) for x, c in ((plain, None), (by_ids, "ids"))]
    assert (found[0].of == found[1].of).all() and np.allclose(found[0].within, found[1].within)
    model = lm_score.fit(by_ids, counts, frequent, PATH, PATTERN, steps=5, ids_col="ids")
    scores = [sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 3)) for r in lm_score.score(x, counts, frequent, model, ids_col=c).collect()) for x, c in ((plain, None), (by_ids, "ids"))]
    assert scores[0] == scores[1] and len(scores[0]) == len(rows)


def test_only_the_held_back_pieces_are_left_out_of_training(spark):
    rows = [(i, f"short {i}") for i in range(20)] + [(100 + i, " ".join(f"w{i}x{k}" for k in range(3000))) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    chars = 8000
    drawn = lm_score.draw_texts(docs, chars)
    pieces = {t: p.decode() for t, p in drawn}
    long = [t for t, p in pieces.items() if len(p) == chars // 8]
    assert long and any(not text.startswith(pieces[t]) for t in long for _, text in rows if pieces[t] in text)  # pieces from anywhere
    by_hash = {r.t: r.text for r in docs.selectExpr("xxhash64(text) as t", "text").collect()}
    want = []
    for t, text in by_hash.items():
        if t not in pieces:
            want.append(text)
        elif len(text) > chars // 8:
            before, after = text.split(pieces[t])
            want.append(before + " " + after)
    got = lm_score._without_pieces(docs, list(pieces), chars, PATH, PATTERN, "text", None)
    assert sorted(r.text for r in got.collect()) == sorted(want)
    stored = lm_score._without_pieces(lm_score.with_ids(docs, PATH, PATTERN), list(pieces), chars, PATH, PATTERN, "text", "ids")
    assert sorted(len(r.ids) for r in stored.collect()) == sorted(2 * len(SUBWORDS.texts([t.encode()])[0]) for t in want)
