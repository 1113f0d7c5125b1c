import math
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from opinio.llm.language_id import ORDER, Sparse, _kneser_ney, count_grams, fit, identify, join_models


def rows(seed, n):
    rng = random.Random(seed)
    parts = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["str", "ein", "ung", "äch"], "cc": ["ξο", "λα", "ρη"]}
    return [(rng.choice("x" * 9 + "y"), lang, " ".join("".join(rng.choices(p, k=3)) for _ in range(rng.randint(1, 40)))) for lang, p in parts.items() for _ in range(n)]


def plain_logp(texts, text):
    """Interpolated Kneser-Ney by dictionaries, for one language."""
    pad = " " * (ORDER - 1)
    norm = lambda t: "".join(c if c.isalpha() else " " for c in t.lower())
    squeeze = lambda t: " ".join(norm(t).split()) + (" " if norm(t).endswith(" ") and norm(t).strip() else "")
    grams = [Counter() for _ in range(ORDER + 1)]
    for t in texts:
        s = pad + squeeze(t)
        for i in range(len(pad), len(s)):
            grams[ORDER][s[i - ORDER + 1 : i + 1]] += 1
    for k in range(ORDER - 1, 0, -1):
        for g in grams[k + 1]:
            grams[k][g[1:]] += 1
    alphabet = len(grams[1]) + 1
    discount = []
    for k in range(ORDER + 1):
        c = Counter(grams[k].values())
        discount.append(c[1] / (c[1] + 2 * c[2]) if c[1] and c[2] else 0.5)

    def p(g):
        if not g:
            return 1 / alphabet
        k, h = len(g), g[:-1]
        total = sum(n for x, n in grams[k].items() if x[:-1] == h)
        lower = p(g[1:])
        if not total:
            return lower
        kinds = sum(1 for x in grams[k] if x[:-1] == h)
        return max(grams[k][g] - discount[k], 0) / total * (g in grams[k]) + discount[k] * kinds / total * lower

    s = pad + squeeze(text)
    return sum(math.log(p(s[i - ORDER + 1 : i + 1])) for i in range(len(pad), len(s))), len(s) - len(pad)


def test_equals_plain_kneser_ney():
    own = ["banana bandana, Anna!", "ban the ANNA... banner", "nab"]
    model = join_models({"xx": count_grams(own)})
    for text in ("banana", "Ban zebra", "an", "é"):
        entropy, n = model.cross_entropy([text])
        want, chars = plain_logp(own, text)
        assert n[0] == chars
        assert abs(-want / chars - entropy[0, 0]) < 1e-4


def test_languages_of_unseen_texts(spark):
    taught = spark.createDataFrame(rows(1, 60), "x string, lang string, text string")
    model = fit(taught, F.lit(True))
    docs = spark.createDataFrame([(i, lang, t) for i, (_, lang, t) in enumerate(rows(2, 30))], "doc_id long, want string, text string")
    got = identify(docs, model).join(docs, "doc_id").collect()
    assert sum(r.lang_pred == r.want for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, "zzqx wqzx xxqz zqzq" * 5)], "doc_id long, text string")
    assert not identify(odd, model).first().accepted


def test_defined_cases(spark):
    taught = spark.createDataFrame([("aa", "ka lo"), ("bb", "str ein"), (None, "zz"), ("cc", None), ("dd", "123")], "lang string, text string")
    model = fit(taught, F.lit(True))
    assert model.languages == ["aa", "bb"]
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "ka"), (4, "ka"), (None, "ein")], "doc_id long, text string").selectExpr("*", "1 as id", "2 as score")
    got = sorted(((r.doc_id or 9, r.lang_pred, r.score == 0, r.accepted) for r in identify(docs, model).collect()))
    assert [g[:3] for g in got] == [(1, "und", True), (2, "und", True), (3, "und", True), (4, "aa", False), (4, "aa", False), (9, "bb", False)]
    assert {r.lang_pred for r in identify(docs, fit(taught.limit(0), F.lit(True))).collect()} == {"und"}
    assert identify(docs.limit(0), model).count() == 0
    long = spark.createDataFrame([(1, "ka lo mi " * 100_000)], "doc_id long, text string")
    assert identify(long, model).first().lang_pred == "aa"
    assert np.isfinite(identify(long, model).first().cross_entropy)


def test_every_labelled_language_has_a_model_whatever_is_copied(spark):
    own = [(lang, t) for _, lang, t in rows(3, 400) if lang == "aa"]
    own += [("bb", "streinung äch " * 3)] * 5000
    own += [("cc", "ξολα " * k) for k in range(1, 8) for _ in range(850)] + [("dd", "zum")]
    taught = spark.createDataFrame(own, "lang string, text string").repartition(4)
    for texts in (600, 100, 1):
        assert set(fit(taught, F.lit(True), sample_texts=texts).languages) >= ({"aa", "bb", "cc", "dd"} if texts > 1 else {"bb", "dd"})
    docs = spark.createDataFrame([(1, "einung strstr"), (2, "λαξο λα"), (3, "kalo mita")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in identify(docs, fit(taught, F.lit(True))).collect()} == {1: "bb", 2: "cc", 3: "aa"}


def test_many_languages_are_told_apart_in_little_memory():
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    own = {f"l{k:03}": rng.sample(letters, 40) for k in range(500)}
    write = lambda lang: " ".join("".join(rng.choices(own[lang], k=4)) for _ in range(60))
    counts = {lang: count_grams([write(lang) for _ in range(5)]) for lang in own}
    tracemalloc.start()
    model = join_models(counts)
    entropy, _ = model.cross_entropy([write(lang) for lang in list(own)[:50]])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200e6, most
    assert (entropy.argmin(axis=1) == np.arange(50)).mean() > 0.95


def test_each_language_scores_as_if_it_were_alone():
    texts = {"xx": ["banana bandana, Anna!", "ban the ANNA... banner"], "yy": ["the annual ban", "then the thin"], "zz": ["λόγος ban"]}
    model = join_models({lang: count_grams(t) for lang, t in texts.items()})
    letters = {c for t in texts.values() for x in t for c in x.lower() if c.isalpha()} | {" "}
    alone = {lang: join_models({lang: count_grams(t)}) for lang, t in texts.items()}
    for text in ("ban the banana", "thin λόγος", "qqq the"):
        got = model.cross_entropy([text])[0][0]
        for k, lang in enumerate(sorted(texts)):
            one = alone[lang]
            plain = join_models({lang: count_grams(texts[lang])})
            plain.unseen = model.unseen
            assert model.unseen == -math.log(len(letters) + 1) and one.unseen >= model.unseen
            # the alphabet is common: a language's own model with it gives the same
            for level, (gram, logp, _, _) in zip(plain.levels, _kneser_ney(count_grams(texts[lang]), model.unseen), strict=True):
                level.grams = Sparse.joined([(gram, logp)])
            assert abs(plain.cross_entropy([text])[0][0, 0] - got[k]) < 1e-4
