"""Benchmark decontamination (9): suffix arrays over shards of the training
text, in which every suffix of the benchmark items is binary-searched.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z folded.
A window is ``window`` consecutive words of an item; an item with fewer words
is one window.  A shard is a block of whole documents.  Its suffix array sorts
the suffixes that begin a run of benchmark words at least as long as the
shortest window (no other suffix can hold a window); prefix doubling orders
them by as many words as the longest item has.  The search narrows the range of
each item suffix word by word, which gives every occurrence of its window and
its longest verbatim match (of a window or more) with the place of it.

Shards are independent, so nothing is shuffled and no document meets another.
The benchmark is read in blocks of bounded size; each block is broadcast and
searched in one narrow pass over the documents, and the passes hand on a bit
per word, so that words hit by several blocks count once.

Defined cases: a null or word-less text has no words and is clean; null or
word-less items have no window; a very long document stays whole in one shard; an empty benchmark leaves every document clean.
Repeated items count by distinct item id; a null item id is found but not
listed.  Repeated rows stay; other columns are not read by
``match_documents`` and are handed on by ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.common import blocks, utf8
from opinio.llm.words import ALNUM, hashed

#: Bytes of item text that one broadcast block holds.
BENCHMARK_BYTES = 8 << 20


@dataclass
class Queries:
    """The suffixes of a block of items that begin with a window."""

    vocabulary: np.ndarray  # sorted word hashes; its word i is number i + 1 below
    words: np.ndarray  # the items' words one after the other, each item ended by 0
    starts: np.ndarray  # first word of each suffix
    lengths: np.ndarray  # words from there to the end of the item
    windows: np.ndarray  # words of the window
    items: np.ndarray  # index of the item
    ids: list[str | None]


def item_queries(ids: list, texts: list[str | None], window: int) -> Queries:
    data, offsets = utf8(pa.array(texts, pa.string()))
    words, _, _, counts = hashed(data, offsets, ALNUM, True)
    vocabulary = np.unique(words)
    n = np.diff(counts)
    items = np.repeat(np.arange(len(n)), n)
    index = np.arange(len(words))
    ended = np.zeros(len(words) + len(n) + 1, np.int64)
    ended[index + items] = np.searchsorted(vocabulary, words) + 1
    lengths = counts[1:][items] - index
    windows = np.minimum(n, window)[items]
    own = lengths >= windows
    return Queries(
        vocabulary, ended, (index + items)[own], lengths[own], windows[own], items[own], [None if i is None else str(i) for i in ids]
    )


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by the words from them on, to ``depth`` words at least; 0 ends a run and sorts first."""
    rank = np.append(words, 0)
    everywhere = np.flatnonzero(words)
    done = 1
    while done < depth:
        # ranks by twice as many words, from the ranks of the two halves
        key = rank[everywhere] * (int(rank.max()) + 1) + rank[np.minimum(everywhere + done, len(words))]
        distinct, new = np.unique(key, return_inverse=True)
        rank[everywhere] = new + 1
        done *= 2
        if len(distinct) == len(everywhere):
            break
    return starts[np.argsort(rank[starts], kind="stable")]


def _bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, above: bool) -> np.ndarray:
    """For each query, the first place in its range [low, high) of the sorted array whose word is not below (or is above) ``wanted``."""
    low, high = low.copy(), high.copy()
    while (searching := np.flatnonzero(low < high)).size:
        middle = (low[searching] + high[searching]) >> 1
        found = column[middle]
        right = found <= wanted[searching] if above else found < wanted[searching]
        low[searching[right]] = middle[right] + 1
        high[searching[~right]] = middle[~right]
    return low


def search(words: np.ndarray, q: Queries) -> tuple[list[tuple[np.ndarray, int, np.ndarray]], np.ndarray, np.ndarray]:
    """Binary search of all item suffixes in a shard (``words``; 0 is no
    benchmark word or the end of a text).  Returns, for each distinct window
    that occurs, its places, its length and the queries that begin with it;
    and for each query the length of its longest match and a place of it (-1: none)."""
    longest, at = np.zeros(len(q.starts), np.int64), np.full(len(q.starts), -1)
    occurring: list[tuple[np.ndarray, int, np.ndarray]] = []
    if not len(q.starts):
        return occurring, longest, at
    run_end = np.append(np.flatnonzero(words == 0), len(words))
    position = np.flatnonzero(words)
    in_run = np.searchsorted(run_end, position)
    run_start = np.append(-1, run_end)[in_run] + 1
    shortest = int(q.windows.min())
    long_enough = run_end[in_run] - run_start >= shortest
    position, left = position[long_enough], (run_end[in_run] - position)[long_enough]
    if not len(position):
        return occurring, longest, at
    kept = np.zeros_like(words)
    kept[position] = words[position]
    array = suffix_array(kept, position[left >= shortest], int(q.lengths.max()))
    kept = np.append(kept, 0)
    live = np.arange(len(q.starts))
    low, high = np.zeros(len(live), np.int64), np.full(len(live), len(array))
    for depth in range(int(q.lengths.max())):
        more = q.lengths[live] > depth
        live, low, high = live[more], low[more], high[more]
        column = kept[np.minimum(array + depth, len(words))]
        wanted = q.words[q.starts[live] + depth]
        low, high = _bound(column, low, high, wanted, False), _bound(column, low, high, wanted, True)
        found = low < high
        live, low, high = live[found], low[found], high[found]
        if not len(live):
            break
        longest[live], at[live] = depth + 1, array[low]
        whole = np.flatnonzero(q.windows[live] == depth + 1)
        whole = whole[np.argsort(low[whole], kind="stable")]
        for same in np.split(whole, np.flatnonzero(np.diff(low[whole])) + 1) if len(whole) else []:
            occurring.append((array[low[same[0]] : high[same[0]]], depth + 1, live[same]))
    short = longest < q.windows
    longest[short], at[short] = 0, -1
    return occurring, longest, at


def _search_batches(batches: Iterator[pa.RecordBatch], q: Queries) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for first, last in blocks(offsets):
            yield _search_block(batch.slice(first, last - first), data, offsets[first : last + 1], q)


def _search_block(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, q: Queries) -> pa.RecordBatch:
    hashes, _, _, counts = hashed(data, offsets, ALNUM, True)
    n = len(offsets) - 1
    number = np.minimum(np.searchsorted(q.vocabulary, hashes), max(len(q.vocabulary) - 1, 0))
    known = q.vocabulary[number] == hashes if len(q.vocabulary) else np.zeros(len(hashes), bool)
    text = np.repeat(np.arange(n), np.diff(counts))
    words = np.zeros(len(hashes) + n, np.int64)  # each text is ended by 0
    words[np.arange(len(hashes)) + text] = np.where(known, number + 1, 0)
    occurring, longest, at = search(words, q)
    text_starts = counts[:-1] + np.arange(n)

    def text_of(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(text_starts, places, side="right") - 1

    change = np.zeros(len(words) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for places, size, queries in occurring:
        np.add.at(change, places, 1)
        np.add.at(change, places + size, -1)
        listed = {q.ids[i] for i in np.unique(q.items[queries])} - {None}
        for t in np.unique(text_of(places)).tolist():
            items.setdefault(t, set()).update(listed)
    hit = np.cumsum(change[:-1]) > 0
    best: dict[int, tuple[int, str | None, int]] = {}
    for k in np.flatnonzero(longest).tolist():
        t = int(text_of(at[k : k + 1])[0])
        best[t] = max(best.get(t, (0, None, 0)), (int(longest[k]), q.ids[q.items[k]] or "", int(at[k] - text_starts[t])))
    old = {name: rows.column(name).to_pylist() for name in ("n_hit", "hit", "item_ids", "longest_words", "longest_item", "longest_at")}
    for t in np.unique(text[hit[np.arange(len(hashes)) + text]]).tolist():
        bits = hit[text_starts[t] : text_starts[t] + counts[t + 1] - counts[t]]
        if old["hit"][t]:  # hits of earlier blocks of the benchmark
            bits = bits | (np.unpackbits(np.frombuffer(old["hit"][t], np.uint8))[: len(bits)] > 0)
        old["hit"][t], old["n_hit"][t] = np.packbits(bits).tobytes(), int(bits.sum())
        old["item_ids"][t] = sorted(items.get(t, set()).union(old["item_ids"][t]))
    for t, (size, item, place) in best.items():
        if size > old["longest_words"][t]:
            old["longest_words"][t], old["longest_item"][t], old["longest_at"][t] = size, item, place
    kind = rows.schema
    return pa.RecordBatch.from_arrays(
        [rows.column("id"), rows.column("text"), pa.array(np.diff(counts), pa.int64()), *[pa.array(old[x], kind.field(x).type) for x in old]],
        schema=kind,
    )


def match_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, item_ids (sorted as
    strings), items_sha256, contaminated, longest_words (0: no match),
    longest_item and longest_at (word of the document where it starts)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _matched(rows, benchmark, window, item_col, item_text_col).select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        "longest_words", "longest_item", "longest_at",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that hold a window."""
    rows = docs.select(F.struct("*").alias("id"), F.col(text_col).alias("text"))
    return _matched(rows, benchmark, window, item_col, item_text_col).where("n_hit = 0").select("id.*")


def _matched(rows: DataFrame, benchmark: DataFrame, window: int, item_col: str, item_text_col: str) -> DataFrame:
    spark = rows.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    n = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BENCHMARK_BYTES + 1
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.StringType()),
        *T.StructType.fromDDL("n_words bigint, n_hit bigint, hit binary, item_ids array<string>, longest_words bigint, longest_item string, longest_at bigint"),
    ])
    zero, none = F.lit(0).cast("long"), F.lit(None)
    out = rows.select(
        "id", "text", zero.alias("n_words"), zero.alias("n_hit"), F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("item_ids"),
        zero.alias("longest_words"), none.cast("string").alias("longest_item"), none.cast("long").alias("longest_at"),
    )
    for part in range(n):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == part).collect()
        queries = spark.sparkContext.broadcast(item_queries([r[0] for r in block], [r[1] for r in block], window))
        out = out.mapInArrow(partial(_search_with, queries), schema)
    return out


def _search_with(queries: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _search_batches(batches, queries.value)
