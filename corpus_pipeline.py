"""Corpus pipeline: toxic documents go, repeated runs are deleted, one document
of each group of near duplicates stays, contaminated documents go, and what is
left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's documents.  The rules of each
operator on nulls, empty texts, ties, repeated rows and other columns hold; a
document of which line deduplication leaves no word goes, one that had none
before stays (a null text as an empty one).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm import toxicity
from opinio.llm.bpe import encode_digests
from opinio.llm.common import table
from opinio.llm.decontaminate import drop_contaminated
from opinio.llm.jaccard_join import one_of_each
from opinio.llm.line_dedup import dedup_lines
from opinio.llm.queries import toxic_labels
from opinio.sources.storage import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6; learns from the labels that its query learns from."""
    net = toxicity.fit(docs, toxic_labels(spark, sf_dir))
    return toxicity.score(docs, net).where("predicted = 0").select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1; ``n_chars`` follows the text."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = dedup_lines(docs, keep=others).where("n_removed < n_words or n_words = 0")
    values = {"doc_id": F.col("row.doc_id"), "text": F.col("text"), **{c: F.col("row").getField(c) for c in others}}
    if "n_chars" in others:
        values["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return out.select(*[values[c].alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5."""
    return one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4."""
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeats),
    ("jaccard_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: SQL expresses neither the network nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.parquet(f"{root}/{k}-{name}")
    return docs
