"""Large CSV files with line breaks inside quotes, read by many tasks.

Spark cuts a text file at line breaks, which inside a quoted field are no ends of
records.  Two passes put the records together again:

1. Every split reports how many quotes it holds.  In RFC 4180 text a place lies
   inside quotes iff an odd number of quotes stands before it, so the running sum
   over a file's splits (one row per split) says in which state each one begins.
2. Each task goes over its lines from that state on.  A line that begins outside
   quotes begins a record; lines up to the next such line belong to it.  What a
   split holds of a record that it does not hold whole is a fragment, at most two
   per split; fragments are put together by a window over the file's fragments.

A record keeps the place where it begins (file, split, number there), which gives
the exact file order.  A file whose quotes do not balance is not RFC 4180 and is
refused.  Records end at ``\\n`` or ``\\r\\n``; empty lines between records count as
none, as Spark's reader has it.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.operators.batching import FILE_POSITION_COLS
from opinio.sources.storage import scratch_path

_NAME, _BLOCK, _POS = FILE_POSITION_COLS
_WHOLE, _OPENS, _GOES_ON = 0, 1, 2


class UnbalancedQuotes(ValueError):
    """A CSV file ends inside a quoted field."""


def _parts(odd: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits -> whole records and fragments (split, pos, piece, record)."""
    split = None
    inside, place, begun, pending = 0, 0, False, []  # quotes' parity, next record, whether the pending lines begin here

    def rows(texts: pa.Array, first: int, piece: int) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, split)), pa.array(np.arange(first, first + n)), pa.array(np.full(n, piece, np.int32)), texts.cast(pa.string())], ["split", "pos", "piece", "record"]
        )

    def left() -> Iterator[pa.RecordBatch]:
        """The pending lines, as a record if they are one and otherwise as a fragment."""
        nonlocal place, pending
        if pending:
            text = "\n".join(pc.binary_join(pa.ListArray.from_arrays([0, len(x)], x), "\n")[0].as_py() for x in pending)
            if not begun:
                yield rows(pa.array([text]), -1, _GOES_ON)
            elif inside or text not in ("", "\r"):
                yield rows(pa.array([text]), place, _OPENS if inside else _WHOLE)
                place += 1
        pending = []

    for batch in batches:
        splits = batch.column("split").to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, splits[1:] != splits[:-1])), len(splits))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b == a:
                continue
            if splits[a] != split:
                yield from left()
                split, place, begun = int(splits[a]), 0, False
                inside = int(split in odd.value)
            lines = batch.column("value").slice(a, b - a)
            quotes = pc.count_substring(lines, '"').to_numpy()
            after = inside + np.cumsum(quotes)
            starts = np.flatnonzero((after - quotes) % 2 == 0)
            if not len(starts):
                pending.append(lines)
                inside = int(after[-1] % 2)
                continue
            if starts[0]:
                pending.append(lines.slice(0, starts[0]))
            inside = 0
            yield from left()
            if len(starts) > 1:
                lists = pa.ListArray.from_arrays(pa.array((starts - starts[0]).astype(np.int32)), lines.slice(starts[0], starts[-1] - starts[0]))
                texts = pc.binary_join(lists, "\n")
                texts = texts.filter(pc.invert(pc.is_in(texts, pa.array(["", "\r"]))))
                yield rows(texts, place, _WHOLE)
                place += len(texts)
            pending, begun, inside = [lines.slice(starts[-1])], True, int(after[-1] % 2)
    yield from left()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record (``record``: its text) of the CSV files at ``path``, with ``FILE_POSITION_COLS``.

    The records stand in a table in the shared checkpoint folder, so their places
    are fixed in storage."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.input_file_name().alias(_NAME), F.input_file_block_start().alias(_BLOCK), F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"), "value")
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    root = scratch_path(spark, "csv-records")
    lines.groupBy("split", _NAME, _BLOCK).agg(F.sum(quotes.cast("long")).alias("quotes")).write.parquet(f"{root}/splits")
    splits = spark.read.parquet(f"{root}/splits")
    if splits.groupBy("split").count().where("count > 1").first():
        raise RuntimeError("two splits have one hash")  # 64 bits; names of splits are not data
    open_files = splits.groupBy(_NAME).agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1")
    if bad := open_files.first():
        raise UnbalancedQuotes(f"{bad[0]} ends inside a quoted field")
    by_file = Window.partitionBy(_NAME)
    before = F.sum("quotes").over(by_file.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    # eight bytes for each split that begins inside quotes, a split being some 128 MB of input
    odd = splits.withColumn("before", before).where("before % 2 = 1").select("split").toArrow().column(0).to_pylist()
    sent = spark.sparkContext.broadcast(frozenset(odd))
    lines.select("split", "value").mapInArrow(partial(_parts, sent), "split bigint, pos bigint, piece int, record string").write.parquet(f"{root}/parts")
    placed = spark.read.parquet(f"{root}/parts").join(splits.drop("quotes"), "split").withColumnRenamed("pos", _POS).drop("split")
    began = F.sum(F.when(F.col("piece") == _OPENS, 1).otherwise(0)).over(by_file.orderBy(_BLOCK, _POS))
    pieces = F.array_sort(F.collect_list(F.struct(_BLOCK, _POS, "record")))
    joined = (
        placed.where(F.col("piece") != _WHOLE).withColumn("began", began).groupBy(_NAME, "began").agg(pieces.alias("p"))
        .select(_NAME, F.col("p")[0][_BLOCK].alias(_BLOCK), F.col("p")[0][_POS].alias(_POS), F.array_join(F.col("p.record"), "\n").alias("record"))
    )
    whole = placed.where(F.col("piece") == _WHOLE).select(*FILE_POSITION_COLS, "record").unionByName(joined)
    return whole.withColumn("record", F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, char_length(record) - 1)")).otherwise(F.col("record")))


def header_names(record: str) -> list[str]:
    return next(csv.reader([record.lstrip("\ufeff")]))


def split_csv(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """The CSV files at ``path``, all strings, with ``FILE_POSITION_COLS``; each file by its own header record, united by name."""
    records = csv_records(spark, path)
    first = (F.col(_BLOCK) == 0) & (F.col(_POS) == 0)
    headers = records.where(first).select(_NAME, F.col("record").alias("header"))
    kinds = sorted(r[0] for r in headers.select("header").distinct().collect())  # a source has few
    body = records.where(~first)
    out = None
    for kind in kinds:
        names = header_names(kind)
        part = body if len(kinds) == 1 else body.join(headers.where(F.col("header") == kind).select(_NAME), _NAME)
        schema = ", ".join(f"_{k} string" for k in range(len(names)))
        cells = part.select(*FILE_POSITION_COLS, F.from_csv("record", schema, options).alias("v"))
        part = cells.select(*FILE_POSITION_COLS, *[F.col("v")[f"_{k}"].alias(n) for k, n in enumerate(names)])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return body.drop("record") if out is None else out
