import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from opinio.llm.bpe import ByteBpe, read_ranks
from tests.llm.test_decontaminate import plain as plain_contamination
from tests.llm.test_jaccard_join import plain as plain_links
from tests.llm.test_line_dedup import WORD
from tests.llm.test_line_dedup import plain as plain_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(4)
    vocabulary = [a + b for a in "abcdefghij" for b in "uvwxyz"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, item = text(60), text(14)
    docs = {i: text(rng.choice([20, 80, 150])) for i in range(60)}
    docs[5] += passage
    docs[9] = docs[9][:10] + passage + docs[9][10:]
    docs[11] = docs[11][:15] + item + docs[11][15:]
    docs[61], docs[62] = list(docs[7]), text(30)
    docs[63] = docs[62] + ["extra"]
    for i in range(0, 60, 4):
        docs[i].insert(3, rng.choice(["grotzen", "vilex"]))
    for i in range(1000, 1300):
        docs[i] = text(rng.choice([15, 40, 70]))
        if i % 3 == 0:
            docs[i][rng.randrange(15)] = rng.choice(["grotzen", "vilex"])
    rows = [(i, rng.choice([" ", "\n"]).join(w), "en", f"s{i % 3}", 1) for i, w in docs.items()]
    rows += [(70, "", None, None, None), (71, None, "en", "s", 0)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(60)] + [(i, 1, int(i % 3 == 0)) for i in range(1000, 1300)]
    return rows, labels, " ".join(item)


def write(spark, root, rows, labels, item):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)] if item else [], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")


def test_stages_are_the_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_equals_brute_force_on_its_input(spark, workdir):
    rows, labels, item = corpus()
    write(spark, workdir, rows, labels, item)
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = {i for i, _, toxic in labels if toxic}

    def step(name, docs):
        stages[name](spark, docs, workdir).write.parquet(f"{workdir}/{name}")
        out = spark.read.parquet(f"{workdir}/{name}")
        assert name == "bpe" or out.columns == COLUMNS
        return out, [(r.doc_id, r.text) for r in docs.collect()], out.collect()

    docs, before, after = step("toxicity", docs)
    gone = {i for i, _ in before} - {r.doc_id for r in after}
    assert len(gone ^ known) <= 4
    docs, before, after = step("line_dedup", docs)
    want = [(i, w) for i, w in plain_lines(before, 50) if w or any(str(d) == i and not WORD.findall(t or "") for d, t in before)]
    assert sorted((str(r.doc_id), WORD.findall(r.text)) for r in after) == want
    assert all(r.n_chars in (len(r.text), 1, 0, None) for r in after)
    docs, before, after = step("jaccard_join", docs)
    groups = plain_links(before)
    assert sorted(r.doc_id for r in after) == sorted({g[3] for g in groups})
    docs, before, after = step("decontamination", docs)
    clean = [d[0] for d in plain_contamination(before, [(1, item)]) if not d[5]]
    assert sorted(r.doc_id for r in after) == sorted(clean) and len(after) < len(before)
    _, before, after = step("bpe", docs)
    ranks = ByteBpe(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN).ranks
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(before)
    assert {r.doc_id for r in after} == set(texts)
    for r in after:
        assert r.n_tokens == len(reference.encode_ordinary(texts[r.doc_id] or ""))
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_run_equals_its_stages_and_empty_tables(spark, workdir):
    rows, labels, item = corpus()
    write(spark, f"{workdir}/some", rows, labels, item)
    write(spark, f"{workdir}/none", [], [], "")
    assert corpus_pipeline.run(spark, f"{workdir}/none").count() == 0
    out = corpus_pipeline.run(spark, f"{workdir}/some")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = {r.doc_id for r in out.collect()}
    assert 11 not in ids and 61 not in ids and 63 not in ids and {62, 70, 71} <= ids
