"""Byte-level BPE encoding and decoding (4).

A text is split by the tokenizer's pattern, and each match is merged on its
own.  A segment tree over the match's byte positions holds the rank of the pair
that starts at each live token; its root is the leftmost pair of minimum rank.
A merge updates the points of the merged token and of its live neighbours, each
in logarithmic time, so a match of any length takes O(n log n).

Matches are remembered per Python worker in a table of bounded size; the table
is emptied when it is full and does not change any result.

Defined cases: null counts as the empty text, which has no ids.  Every text
decodes to its own UTF-8 bytes.  Rows stay as they are, repeated ones too;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Matches that a worker remembers, and their greatest length.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64
_NEVER = 1 << 62


def read_ranks(path: str) -> bytes:
    """The content of a rank file (a vocabulary: bounded size)."""
    with open(path, "rb") as f:
        return f.read()


class ByteBpe(dict):
    """Ids of matches as little-endian 32-bit integers, by match; encodes on first use."""

    def __init__(self, rank_file: bytes, pattern: str):
        super().__init__()
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # \s of the tokenizers is Unicode's white space, also where a Python engine differs
        self.matches = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def __missing__(self, match: str) -> bytes:
        ids = np.array(self.merge(match.encode()), "<u4").tobytes()
        if len(match) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[match] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        # a leaf is rank * size + position, so the least leaf is the leftmost of minimum rank
        tree = [_NEVER] * (2 * size)
        rank_of = ranks.get
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank * size + i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def put(position: int, value: int) -> None:
            k = size + position
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                if b < a:
                    a = b
                if tree[k] == a:
                    return
                tree[k] = a
                k >>= 1

        after = list(range(1, n + 1))  # start of the next live token; n: none
        before = list(range(-1, n))
        while tree[1] != _NEVER:
            i = tree[1] % size
            j = after[i]
            end = after[i] = after[j]
            before[end] = i
            put(j, _NEVER)
            rank = rank_of(piece[i : after[end]]) if end < n else None
            put(i, _NEVER if rank is None else rank * size + i)
            if i:
                h = before[i]
                rank = rank_of(piece[h:end])
                put(h, _NEVER if rank is None else rank * size + h)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian 32-bit."""
        if len(text) < 1 << 20:
            return b"".join(map(self.__getitem__, self.matches.findall(text)))
        found, parts = self.matches.finditer(text), []
        while part := [m.group() for m in islice(found, 1 << 16)]:
            parts.append(b"".join(map(self.__getitem__, part)))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[int, ByteBpe] = {}


def _loaded(rank_file: bytes, pattern: str) -> ByteBpe:
    key = hash((rank_file, pattern))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(rank_file, pattern)
    return _LOADED[key]


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``ids`` (binary: little-endian 32-bit), ``n_tokens`` and ``decoded`` (binary)."""
    return _coded(docs, rank_path, pattern, id_col, text_col, False)


def encode_digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_documents``, with SHA-256 digests of the ids and of the decoded bytes in their place."""
    return _coded(docs, rank_path, pattern, id_col, text_col, True)


def _coded(docs: DataFrame, rank_path: str, pattern: str, id_col: str, text_col: str, digests: bool) -> DataFrame:
    spark = docs.sparkSession
    rank_file = spark.sparkContext.broadcast(read_ranks(rank_path))
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(rank_file.value, pattern)
        for batch in batches:
            texts = batch.column("text")
            for first in range(0, batch.num_rows, 256):
                ids = [bpe.encode(t.as_py() or "") for t in texts.slice(first, 256)]
                decoded = [bpe.decode(x) for x in ids]
                if digests:
                    shown = [pa.array([hashlib.sha256(x).hexdigest() for x in y], pa.string()) for y in (ids, decoded)]
                else:
                    shown = [pa.array(y, pa.binary()) for y in (ids, decoded)]
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, 256), counts, *shown], ["id", "n_tokens", "ids", "decoded"])

    kind = "string" if digests else "binary"
    out = own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, n_tokens bigint, ids {kind}, decoded {kind}")
    if digests:
        return out.select(out.id.alias(id_col), "n_tokens", out.ids.alias("ids_sha256"), out.decoded.alias("decoded_sha256"))
    return out.select(out.id.alias(id_col), "n_tokens", "ids", "decoded")
