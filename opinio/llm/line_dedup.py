"""Line deduplication (1): winnowing over the hashes of the text's lines of
words, joined positions, matches extended both ways, later repeated runs deleted.

Passages that repeat across documents begin and end inside newline-delimited
lines, where hashes of whole lines can't meet; so a "line" here is every run of
``LINE`` words, wherever it begins.  Of each ``WINDOW = MIN_WORDS - LINE + 1``
consecutive line hashes the least is a fingerprint.  A
run of ``MIN_WORDS`` words that two places share holds the same full window at
both, hence the same fingerprint: none is missed.

1. Fingerprints are counted by hash; those that two different texts share, or
   that one text has twice, are joined back to their positions.
2. A position is extended both ways to the run of ``MIN_WORDS`` words whose
   window it is the least of, and the run is hashed.  A run stands once for a
   text, with the spans of its later places there, so that a text of one repeated
   word is a row, not thousands.  Equal runs meet in a group-by that finds the
   least id; occurrences in other documents, and later ones in a document, are
   repeats.  Overlapping ones join to maximal runs before they go to the texts.
3. The words of later repeats are deleted.  A document whose whole text is that
   of an earlier one is one such run (if it has ``MIN_WORDS`` words).

A deleted word always has an equal, earlier run that stays, or whose words stay
elsewhere.  Runs shorter than ``MIN_WORDS`` words stay.  No group is collected
but the positions of one document; hashes of hot lines and passages are combined
before each shuffle and joined where Spark splits skewed partitions.  Texts that
share no line with another are not shuffled, as far as a broadcast map of bounded
size tells them apart.  Lines and runs count as equal if their 64-bit hashes
are; their words are not compared.

Defined cases: null counts as the empty text and is returned empty.  A null id
comes after every other id.  Equal rows (id and text) are one occurrence and
keep the same words; different texts of one id do not repeat each other.  Within
a text a repeat deletes only words after the first occurrence's end.  A deleted
run takes the white space beside it; one line break stays where it held one.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import blocks, utf8
from opinio.llm.words import NOT_SPACE, grams, hashed, prefix, spans_hash, split

#: Words of the shortest run that is deleted, and of a hashed line.
MIN_WORDS, LINE = 50, 16
#: Slots of the map of texts that take part in a repeat: the most that is broadcast.
SLOTS = 1 << 20


def least(hashes: np.ndarray, first: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each full window of ``width`` consecutive lines (hash, first word, place
    in the text): the window's first line and its least one, by index.  Of equal
    hashes the one whose place modulo ``width`` is least, so that windows of a
    repeated word choose the same line instead of one each."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tie = (at % width).astype(np.int32)
    value, index, span = hashes, np.arange(len(hashes)), 1

    def smaller(b: int, m: int) -> None:
        nonlocal value, index
        x, y, i, j = value[:m], value[b : b + m], index[:m], index[b : b + m]
        right = (y < x) | ((y == x) & (tie[j] < tie[i]))
        value, index = np.where(right, y, x), np.where(right, j, i)

    while 2 * span <= width:
        smaller(span, len(value) - span)
        span *= 2
    if span < width:
        smaller(width - span, n)
    whole = first[width - 1 :] - first[:n] == width - 1
    return np.flatnonzero(whole), index[:n][whole]


def _lines(data: np.ndarray, offsets: np.ndarray, min_words: int, line: int):
    """Words of a block; line hashes with their first words; windows and their least lines."""
    words, _, _, counts = hashed(data, offsets, NOT_SPACE, False)
    hashes, first = grams(words, counts, line)
    text = np.searchsorted(counts, first, side="right") - 1
    window, chosen = least(hashes, first, first - counts[text], min_words - line + 1)
    inside = first[window] + min_words <= counts[text[window] + 1]
    return words, counts, hashes, first, window[inside], chosen[inside]


def _fingerprints(min_words: int, line: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets):
            _, counts, hashes, first, _, chosen = _lines(data, offsets[a : b + 1], min_words, line)
            chosen = np.unique(chosen)
            text = np.searchsorted(counts, first[chosen], side="right") - 1
            h = hashes[chosen]
            order = np.lexsort((h, text))
            again = np.zeros(len(h), bool)
            same = (text[order][1:] == text[order][:-1]) & (h[order][1:] == h[order][:-1])
            again[order[1:][same]] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), batch.column("t").slice(a, b - a).take(pa.array(text)), pa.array((first[chosen] - counts[text]).astype(np.int32)), pa.array(again)],
                ["h", "t", "at", "again"],
            )


def _runs(min_words: int, line: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets):
            words, counts, _, first, window, chosen = _lines(data, offsets[a : b + 1], min_words, line)
            lists = batch.column("at").slice(a, b - a)
            shared = np.repeat(counts[:-1], pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)) + lists.flatten().to_numpy()
            keep = np.isin(first[chosen], shared)
            start = first[window[keep]]
            text = np.searchsorted(counts, start, side="right") - 1
            g = spans_hash(prefix(words), start, start + min_words)
            # a run once a text: its first place, and the spans of its later places, those that touch as one
            order = np.lexsort((start, g, text))
            text, g, at = text[order], g[order], (start - counts[text])[order]
            new = np.append(True, (g[1:] != g[:-1]) | (text[1:] != text[:-1]))[: len(g)]
            begins = ~new & np.append(True, new[:-1] | (at[1:] > at[:-1] + min_words))[: len(g)]
            ends = ~new & np.append(begins[1:] | new[1:], True)[: len(g)]
            spans = np.append(0, np.cumsum(begins))
            firsts = np.flatnonzero(new)
            until = np.append(spans[firsts], spans[-1]).astype(np.int32)
            others = pa.ListArray.from_arrays(pa.array(until), pa.array((at[begins] << 32) + at[ends] + min_words), mask=pa.array(until[1:] == until[:-1]))
            taken, rows = pa.array(text[firsts]), batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[firsts].view(np.int64)), rows.column("id").take(taken), rows.column("t").take(taken), pa.array(at[firsts].astype(np.int32)), others],
                ["g", "id", "t", "at", "others"],
            )


def cut(text: bytes, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> bytes:
    """``text`` without the words that are not kept and the white space beside them."""
    edges = np.diff(np.concatenate([[0], kept.astype(np.int8), [0]]))
    out: list[bytes] = []
    last = -1
    for i, j in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        if i == 0:
            out.append(text[: starts[0]])
        elif out:
            left, right = text[ends[last] : starts[last + 1]], text[ends[i - 1] : starts[i]]
            out.append(b"\n" if b"\n" in right and b"\n" not in left else left)
        out.append(text[starts[i] : ends[j - 1]])
        last = j - 1
    if out and kept[-1]:
        out.append(text[ends[-1] :])
    return b"".join(out)


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words and ends of the unions of overlapping or touching spans, and the index of each one's first span."""
    order = np.argsort(spans, kind="stable")
    begin, until = spans[order] >> 32, np.maximum.accumulate(spans[order] & 0xFFFFFFFF)
    new = np.flatnonzero(np.append(True, begin[1:] > until[:-1]))
    return begin[new], until[np.append(new[1:], len(spans)) - 1], order[new]


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text as their unions, with the source of the first."""
    for batch in batches:
        lists = batch.column("repeats")
        until = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).cumsum()
        spans, sources = lists.flatten().field("span").to_numpy(), lists.flatten().field("source")
        joined, taken, sizes = [], [], [0]
        for before, after in zip(np.append(0, until[:-1]).tolist(), until.tolist(), strict=True):
            begin, end, i = merged(spans[before:after])
            joined.append((begin << 32) + end)
            taken.append(before + i)
            sizes.append(len(begin))
        unions = pa.StructArray.from_arrays([pa.array(np.concatenate(joined)), sources.take(pa.array(np.concatenate(taken)))], ["span", "source"])
        repeats = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), unions)
        yield pa.RecordBatch.from_arrays([batch.column("rt"), batch.column("rid"), repeats], ["rt", "rid", "repeats"])


def _cut_rows(min_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in blocks(utf8(batch.column("text"))[1]):
            rows = batch.slice(a, b - a)
            texts, all_words, removed, all_runs = [], [], [], []
            data, offsets = utf8(rows.column("text"))
            # a text of one repeated word has thousands of spans: they stay arrays
            lists = rows.column("repeats")
            until = pa.compute.list_value_length(lists).fill_null(0).to_numpy().cumsum()
            spans, sources = lists.flatten().field("span").to_numpy(), lists.flatten().field("source")
            for k, (copy, source) in enumerate(zip(rows.column("copy").to_pylist(), rows.column("source").to_pylist(), strict=True)):
                body = data[offsets[k] : offsets[k + 1]].tobytes()
                starts, ends, _ = split(data, offsets[k : k + 2], NOT_SPACE)
                n, runs, before = len(starts), [], until[k - 1] if k else 0
                if copy and n >= min_words:
                    runs = [{"start": 0, "words": n, "source": source}]
                    kept = np.zeros(n, bool)
                elif until[k] > before and not copy:
                    kept = np.ones(n, bool)
                    for begin, end, i in zip(*(x.tolist() for x in merged(spans[before : until[k]])), strict=True):
                        runs.append({"start": begin, "words": end - begin, "source": sources[int(before) + i].as_py()})
                        kept[begin:end] = False
                texts.append(cut(body, starts, ends, kept) if runs else body)
                all_words.append(n)
                removed.append(int((~kept).sum()) if runs else 0)
                all_runs.append(runs)
            source_type = batch.schema.field("source").type
            run_type = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("source", source_type)]))
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(all_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(all_runs, run_type)],
                ["row", "text", "n_words", "n_removed", "runs"],
            )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, line: int = LINE,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``row`` (the id and the columns named in
    ``keep``), the text that stays, n_words, n_removed, and the deleted runs
    (first word, words, id of the earliest document with the run's beginning)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"), *([F.struct(*keep).alias("kept")] if keep else []))
    own = own.select("*", F.xxhash64("text").alias("t"), F.xxhash64(F.lit(1), "text").alias("t2"))
    kind = own.schema["id"].dataType.simpleString()

    prints = own.select("t", "text").mapInArrow(partial(_fingerprints, min_words, line), "h bigint, t bigint, at int, again boolean")
    seen = prints.groupBy("h").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.max("again").alias("again"))
    shared = prints.select("h", "t", "at").join(seen.where("low <> high or again").select("h"), "h", "left_semi")
    shared = shared.groupBy("t").agg(F.collect_set("at").alias("at"))
    first = own.groupBy("t", "t2").agg(F.min("id").alias("source"), F.count(F.lit(1)).alias("n"))
    wanted = first.join(shared, "t", "left").where("at is not null or n > 1")

    # Texts that share nothing stay where they are: a map of SLOTS slots tells (and tells the rest in passing)
    slot = F.pmod(F.col("t"), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(wanted.select(slot).distinct())
    own = own.withColumn("slot", slot)
    touched, alone = (own.join(slots, "slot", how).drop("slot") for how in ("left_semi", "left_anti"))

    # not an equality (source is the least id), so that both joins of the texts share one exchange by (t, t2)
    earliest = (F.col("id") <= F.col("source")) | (F.col("id").isNull() & F.col("source").isNull())
    runs = touched.join(wanted.where("at is not null"), ["t", "t2"]).where(earliest).select("id", "t", "text", "at")
    runs = runs.mapInArrow(partial(_runs, min_words, line), f"g bigint, id {kind}, t bigint, at int, others array<bigint>")
    origin = runs.groupBy("g").agg(F.min("id").alias("low"))
    elsewhere = F.col("low").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("low")))
    later = runs.join(origin, "g").where(elsewhere | F.col("others").isNotNull())
    # a span: first word, and the one after the last; within a text only words after the first occurrence's end go
    until = F.col("at").cast("bigint") + min_words
    here = F.array(F.shiftleft(F.col("at").cast("bigint"), 32) + until)
    after = F.transform("others", lambda x: F.shiftleft(F.greatest(F.shiftright(x, 32), until), 32) + x.bitwiseAND(F.lit(0xFFFFFFFF)))
    spans = F.when(elsewhere & F.col("others").isNull(), here).when(elsewhere, F.concat(here, "others")).otherwise(after)
    repeat = F.struct("span", F.coalesce("low", "id").alias("source"))
    repeats = later.withColumn("span", F.explode(spans)).groupBy(F.col("t").alias("rt"), F.col("id").alias("rid")).agg(F.collect_set(repeat).alias("repeats"))
    repeats = repeats.mapInArrow(_merge_spans, f"rt bigint, rid {kind}, repeats array<struct<span:bigint,source:{kind}>>")

    told = first.join(repeats, (F.col("t") == F.col("rt")) & F.col("source").eqNullSafe(F.col("rid")), "left").where("n > 1 or repeats is not null")
    told = told.select("t", "t2", "source", "repeats")
    found = touched.join(told, ["t", "t2"], "left")
    copy = F.col("id").isNull() & F.col("source").isNotNull() | (F.col("id") > F.col("source"))
    out = found.withColumn("copy", F.coalesce(copy, F.lit(False))).unionByName(alone.withColumn("copy", F.lit(False)), allowMissingColumns=True)
    row = F.struct(F.col("id").alias(id_col), *[F.col(f"kept.{c}").alias(c) for c in keep])
    out = out.select(row.alias("row"), "text", "copy", "source", "repeats")
    run = f"array<struct<start:bigint,words:bigint,source:{kind}>>"
    return out.mapInArrow(
        partial(_cut_rows, min_words), f"row {out.schema['row'].dataType.simpleString()}, text string, n_words bigint, n_removed bigint, runs {run}"
    )
