"""Cross-tokenizer alignment (13).

A text is encoded by two tokenizers: A reads a space and the text, B the text
(before which it puts a space itself).  Both token lists cut the same bytes.
The cumulative byte ends of each list are the keys of a dictionary from end to
token index; the intersection of the two key sets, sorted, slices both lists
into the least groups whose borders agree.  Links are expanded slice by slice:
every A token with every B token of the slice whose byte ranges overlap.

A's vocabulary is read from its JSON file, which must be a byte-level BPE whose
merges are numbered in their order (checked), so that the rank-driven library
gives the same ids as the file's own in a quarter of its time (measured; compared
with it in the tests).

``align`` yields groups and links of each row.  ``link_statistics`` adds what
needs the corpus: an id pair's count is the number of rows that hold it linked,
and a link is best if no other pair of its A id counts more.

One pass encodes and writes a narrow table (per row its digests and distinct id
pairs); pairs are then counted by a combined shuffle.  The pairs at or above a
count that at most ``FREQUENT`` pairs reach are broadcast, each occurrence of
another pair is a narrow row joined with its count; both ways give the same
numbers, so the bound changes no result and no pair's rows meet in one task.

Defined cases: a null or empty text, and one whose joined bytes by A or B are
not a space and the text (a piece that the tokenizer replaces), has no tokens:
counts 0 and an empty digest.  A very long text is encoded whole by its task.
Repeated rows and repeated or null ids each count as a row of their own; an
empty table gives an empty one.  Only the id and the text are read, other
columns' names may clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from opinio.llm.common import blocks, utf8
from opinio.sources.storage import scratch_path

#: Pairs that are broadcast with their counts (17 bytes each).
FREQUENT = 1 << 20

def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    bytes of Latin-1 stand for themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(other)}


class Aligner:
    """Two tokenizers, the bytes and the written form of their ids."""

    def __init__(self, json_file: bytes, model_file: bytes, pattern: str):
        spec = json.loads(json_file)
        vocab = spec["model"]["vocab"]
        byte = byte_alphabet()
        self.a_bytes = {k: bytes(map(byte.__getitem__, token)) for token, k in vocab.items()}
        if not plain(spec):
            raise ValueError("tokenizer A is not a byte-level BPE whose merges are numbered in their order")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={t: k for k, t in self.a_bytes.items()}, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=model_file)
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.n_a, self.n_b = max(self.a_bytes) + 1, len(self.b_bytes)
        self.a_sizes = np.array([len(self.a_bytes.get(k, b"")) for k in range(self.n_a)])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # an id as written inside a group and at its end
        self.names = np.array([f"{k}{c}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for c in ends for k in range(n)], object)

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> Iterator[Aligned]:
        """A text has no tokens where B does not keep its bytes (A, a byte-level BPE, always does)."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            same = bool(b) and b"".join(map(self.b_bytes.__getitem__, b)) == (" " + text).encode()
            ids_a = self.a.encode_to_numpy(" " + text).astype(np.int64) if same else np.zeros(0, np.int64)
            ids_b = np.array(b if same else [], np.int64)
            yield Aligned(ids_a, ids_b, self.a_sizes[ids_a].cumsum(), self.b_sizes[ids_b].cumsum())

    def written(self, x: Aligned) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = np.zeros(len(x.a), int), np.zeros(len(x.b), int)
        last_a[x.cut_a - 1] = last_b[x.cut_b - 1] = 1
        out = np.empty(len(x.a) + len(x.b), int)
        out[np.arange(len(x.a)) + np.repeat(x.cut_b - x.size_b, x.size_a)] = x.a + last_a * self.n_a
        out[np.arange(len(x.b)) + np.repeat(x.cut_a, x.size_b)] = x.b + last_b * self.n_b + 2 * self.n_a
        return "".join(self.names[out].tolist())[:-1]


def plain(spec: dict) -> bool:
    """Whether a tokenizer file is a byte-level BPE that ranks alone describe: every merge makes the next id."""
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    merged = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    by_regex = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    return bool(by_regex) and spec["normalizer"] is None and not any(model.get(o) for o in options) and None not in merged and merged == sorted(set(merged)) and len(model["vocab"]) == len(merged) + 256


class Aligned:
    """The groups and links of two id lists over the same bytes."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.a, self.b, self.ends_a, self.ends_b = a, b, ends_a, ends_b
        index_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1), strict=True))
        index_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1), strict=True))
        common = sorted(index_a.keys() & index_b.keys())
        #: Token index after each group, and tokens in each
        self.cut_a = np.fromiter(map(index_a.__getitem__, common), np.int64, len(common))
        self.cut_b = np.fromiter(map(index_b.__getitem__, common), np.int64, len(common))
        self.size_a, self.size_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)

    def groups(self) -> list[dict]:
        parts = (np.split(ids, cut[:-1]) for ids, cut in ((self.a, self.cut_a), (self.b, self.cut_b)))
        return [{"a": a, "b": b} for a, b in zip(*parts, strict=True)] if len(self.a) else []

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Token indices in A and in B of every link."""
        # a slice with one token on a side: that token overlaps all of the other side
        one = (self.size_a == 1) | (self.size_b == 1)
        size_a, size_b = self.size_a[one], self.size_b[one]
        many = np.maximum(size_a, size_b)
        step = np.arange(many.sum()) - np.repeat(many.cumsum() - many, many)
        at_a = np.repeat(self.cut_a[one] - size_a, many) + step * np.repeat(size_a > 1, many)
        at_b = np.repeat(self.cut_b[one] - size_b, many) + step * np.repeat(size_b > 1, many)
        if one.all():
            return at_a, at_b
        # other slices: each stretch between two neighbouring ends of either side is one link
        in_a, in_b = (np.flatnonzero(np.repeat(~one, size)) for size in (self.size_a, self.size_b))
        ends_a, ends_b = self.ends_a[in_a], self.ends_b[in_b]
        ends = np.union1d(ends_a, ends_b)
        return np.append(at_a, in_a[np.searchsorted(ends_a, ends)]), np.append(at_b, in_b[np.searchsorted(ends_b, ends)])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked id pairs (A id * 2^32 + B id) and the links of each."""
        i, j = self.links()
        return np.unique((self.a[i] << 32) | self.b[j], return_counts=True)


_LOADED: dict[int, Aligner] = {}


def _loaded(files: tuple[bytes, bytes, str]) -> Aligner:
    key = hash(files)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(*files)
    return _LOADED[key]


def _encoded(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[Aligned]]]:
    aligner = _loaded(sent.value)
    for batch in batches:
        texts = batch.column("text")
        offsets = utf8(texts)[1]
        for a, b in blocks(offsets, 1 << 18):
            yield batch.column("id").slice(a, b - a), list(aligner.align([t or "" for t in texts.slice(a, b - a).to_pylist()]))


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else [], kind))


def _groups(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    side = pa.list_(pa.int32())
    group, link = pa.list_(pa.struct([("a", side), ("b", side)])), pa.list_(pa.struct([("a_at", pa.int32()), ("b_at", pa.int32())]))
    for ids, found in _encoded(sent, batches):
        groups = pa.array([x.groups() for x in found], group)
        links = pa.array([[{"a_at": i, "b_at": j} for i, j in sorted(zip(*(y.tolist() for y in x.links()), strict=True))] for x in found], link)
        counts = [pa.array([len(y) for y in x], pa.int64()) for x in ([x.a for x in found], [x.b for x in found])]
        yield pa.RecordBatch.from_arrays([ids, *counts, groups, links], ["id", "n_a", "n_b", "groups", "links"])


def _digests(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row, aligner = TaskContext.get().partitionId() << 40, _loaded(sent.value)
    for ids, found in _encoded(sent, batches):
        pairs = [x.pairs() for x in found]
        shown = [hashlib.sha256(aligner.written(x).encode()).hexdigest() if len(x.a) else "" for x in found]
        n = [[len(x.a), len(x.b), len(x.cut_a), int(times.sum())] for x, (_, times) in zip(found, pairs, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(row, row + len(found))), ids, *(pa.array(c, pa.int64()) for c in zip(*n, strict=True)), pa.array(shown),
             _lists([p for p, _ in pairs], pa.int64()), _lists([t for _, t in pairs], pa.int64())],
            ["at", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
        )
        row += len(found)


def _files(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> Broadcast:
    found = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            found.append(f.read())
    return docs.sparkSession.sparkContext.broadcast((*found, pattern))


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, n_a, n_b, ``groups`` (ids of both sides of each group, in order) and
    ``links`` (token indices); ``path_a`` is a byte-level tokenizer's JSON, ``pattern`` its
    pre-tokenizer's, ``path_b`` a piece model."""
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, n_a bigint, n_b bigint, groups array<struct<a:array<int>,b:array<int>>>, links array<struct<a_at:int,b_at:int>>"
    return own.mapInArrow(partial(_groups, _files(docs, path_a, path_b, pattern)), schema).withColumnRenamed("id", id_col)


@dataclass
class Counted:
    """Pairs of ``least`` rows or more by sorted key, and each A id's highest count (``most[id]``)."""

    pairs: np.ndarray
    n: np.ndarray
    least: int
    most: np.ndarray


def frequent_pairs(counts: DataFrame, limit: int = FREQUENT) -> Counted:
    """``counts`` (pair, n); every A id's highest count is held (one number per id of the vocabulary)."""
    by_size = {r.k: r.pairs for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    least, room = 1, limit
    for k in sorted(by_size, reverse=True):
        room -= by_size[k]
        if room < 0:
            least = 2 << k
            break
    top = counts.where(F.col("n") >= least).toArrow()
    pairs, n = top.column("pair").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(pairs)
    best = counts.groupBy(F.shiftright("pair", 32).cast("int").alias("a")).agg(F.max("n").alias("n")).toArrow()
    a = best.column("a").to_numpy()
    most = np.zeros(int(a.max()) + 1 if len(a) else 1, np.int64)
    most[a] = best.column("n").to_numpy()
    return Counted(pairs[order], n[order], least, most)


def _sums(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: Counted = sent.value
    for batch in batches:
        rows, lists = batch.num_rows, batch.column("pairs")
        pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        row = np.repeat(np.arange(rows), np.diff(lists.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(known.pairs, pair), max(len(known.pairs) - 1, 0))
        found = known.pairs[at] == pair if len(known.pairs) else np.zeros(len(pair), bool)
        n = known.n[at[found]] if found.any() else np.zeros(0, np.int64)
        best = n == known.most[pair[found] >> 32]
        sums = [np.zeros(rows, np.int64) for _ in range(2)]
        np.add.at(sums[0], row[found][best], times[found][best])
        np.add.at(sums[1], row[found], times[found] * n)
        rest = pa.StructArray.from_arrays([pa.array(pair[~found]), pa.array(times[~found])], ["pair", "times"])
        ends = np.append(0, np.cumsum(np.bincount(row[~found], minlength=rows))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("at"), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(ends), rest)], ["at", "n_best", "count_sum", "rest"])


def link_statistics(docs: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", limit: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Two tables.  One row per row of ``docs``: the id, n_a, n_b, n_groups, n_links, n_best (links whose pair counts
    as much as any of their A id), count_sum (over links) and groups_sha256.  One row per linked id pair: ``pair``
    (A id * 2^32 + B id) and ``n``, the rows that hold it linked."""
    spark = docs.sparkSession
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = (
        f"at bigint, id {own.schema['id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs array<bigint>, times array<bigint>"
    )
    root = scratch_path(spark, "token-align")
    own.mapInArrow(partial(_digests, _files(docs, path_a, path_b, pattern)), schema).write.parquet(f"{root}/rows")
    rows = spark.read.schema(schema).parquet(f"{root}/rows")
    rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/counts")
    counts = spark.read.schema("pair bigint, n bigint").parquet(f"{root}/counts")
    known = frequent_pairs(counts, limit)
    sent = spark.sparkContext.broadcast(known)
    summed = rows.select("at", "pairs", "times").mapInArrow(partial(_sums, sent), "at bigint, n_best bigint, count_sum bigint, rest array<struct<pair:bigint,times:bigint>>")
    most = spark.createDataFrame(pa.table({"a": pa.array(np.arange(len(known.most), dtype=np.int32)), "most": known.most}))
    rare = (
        summed.select("at", F.explode("rest").alias("r")).select("at", "r.pair", "r.times")
        .join(counts.where(F.col("n") < known.least), "pair")
        .join(F.broadcast(most), F.shiftright("pair", 32).cast("int") == F.col("a"))
        .select("at", F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(F.lit(0)).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    )
    sums = summed.select("at", "n_best", "count_sum").unionByName(rare).groupBy("at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.drop("pairs", "times").join(sums, "at")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), counts
