"""Queries of the subpackage: thin digests of the operators' results."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import public_tokenizers
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm import language_id, lm_score, oracle, toxicity
from opinio.llm.bpe import encode_digests
from opinio.llm.common import fold, table
from opinio.llm.decontaminate import match_documents
from opinio.llm.exact_dedup import exact_groups
from opinio.llm.html_extract import extract
from opinio.llm.jaccard_join import link_documents
from opinio.llm.line_dedup import dedup_lines
from opinio.llm.period_runs import periodic_runs
from opinio.llm.token_align import link_statistics
from opinio.llm.url_filter import judge_urls
from opinio.llm.warc import read_archives, write_archives
from opinio.sources.storage import scratch_path

#: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup_lines(table(spark, d, "documents")).select("row.*", "text", "n_words", "n_removed", "runs")


def op2_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_groups(table(spark, d, "documents"))


def op3_html_extract(spark: SparkSession, d: str) -> DataFrame:
    return extract(table(spark, d, "pages"), keep=("url",)).select("page_id", "url", "text", "n_chars")


def op4_bpe(spark: SparkSession, d: str) -> DataFrame:
    return encode_digests(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return link_documents(table(spark, d, "documents"))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    net = toxicity.fit(docs, toxic_labels(spark, d))
    row = F.struct("doc_id", (fold("doc_id", 4) == 2).alias("held_out"))
    return toxicity.score(docs, net, row=row).select("row.*", "score", "predicted")


def toxic_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels that may be learned from."""
    return table(spark, d, "labels").where(fold("doc_id", 4) != 2).select("doc_id", F.col("toxic").alias("label"))


def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, d, "pages"), rules)


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    return language_id.identify(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op9_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    out = match_documents(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_lm_score(spark: SparkSession, d: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = lm_score.with_ids(table(spark, d, "documents").select("doc_id", "text"), path, pattern)
    taught = docs.where(fold("doc_id", 7) != 2)
    counts = lm_score.word_counts(taught).persist(StorageLevel.DISK_ONLY)
    frequent = lm_score.frequent_words(counts)
    model = lm_score.fit(taught, counts, frequent, path, pattern, ids_col="ids")
    out = lm_score.score(docs, counts, frequent, model, keep=((fold("doc_id", 7) == 2).alias("held_out"),), ids_col="ids")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_warc(spark: SparkSession, d: str) -> DataFrame:
    path, pages = scratch_path(spark, "warc"), table(spark, d, "pages")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return read_archives(spark, path, payloads=False).select(
        F.col("row_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_row_id").cast(kind).alias("refers_to")
    )


def op12_period_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text"))
    out, best = periodic_runs(docs), F.col("best")
    written = F.concat(F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return out.select(
        "row.*", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"), best.period.alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(written, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text; for every tenth id (by its crc32 h) its words from number a = h // 10 mod n on repeat with a period by h."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    # a lambda's variable is computed once, a column repeated in it for each word
    return F.when(h % 10 == 0, F.get(F.transform(F.filter(F.array(words), lambda w: F.size(w) > 0), planted), 0)).otherwise(text)


def op13_token_align(spark: SparkSession, d: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return link_statistics(table(spark, d, "documents"), *paths, public_tokenizers.PATTERN)[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_line_dedup, op2_exact_dedup, op3_html_extract, op4_bpe, op5_jaccard_join, op6_toxicity, op7_url_filter, op8_language_id, op9_decontaminate, op10_lm_score, op11_warc, op12_period_runs, op13_token_align)
    pipeline = importlib.import_module("corpus_pipeline")  # it imports this module
    return {f.__name__: f for f in own} | {"pipeline": pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
