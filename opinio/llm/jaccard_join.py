"""N-gram Jaccard join (5): chosen-path join over word shingles.

Texts are sets of shingles (five consecutive words; A-Z folded, words as runs of
ASCII letters, digits and other characters beyond ASCII).  Texts with equal sets
are represented by one of them and are not compared again:

1. Each set is mapped to ``COORDINATES`` MinHash values, tokens of which two sets
   share as large a part as their similarity.  A run starts at a root node; a
   node chooses each coordinate with probability 1 / (threshold * COORDINATES),
   and splits its sets by their values there.  Nodes of at most ``BUCKET`` sets
   are leaves and compared by brute force; larger ones split again, down to
   ``DEPTH`` levels, where what is left (sets that hardly differ, or that share a
   hot passage) is compared in pairs of blocks of ``CROWD`` sets.  The number of runs follows from the target recall and the
   survival of a pair at the threshold in ``DEPTH`` levels.
2. A comparison in a leaf estimates the similarity from one byte of each MinHash
   value.  It yields a spanning tree of the sets that look alike, not their
   pairs; the trees' connected components are the clusters to verify.
3. Within each cluster every pair of sets is compared exactly, in pairs of blocks
   of bounded size.  That gives each class its number of links, and spanning
   trees of the true links, whose components are the groups.

No pair is ever a row.  A cluster of n different near copies takes n^2 / 2 exact
comparisons, spread over (n / BLOCK)^2 / 2 tasks' worth of cells: counting all
links of a cluster has that cost.

Defined cases: a text of one to four words has one shingle, all its words; a
null or word-less text has none, is like no other and is a class and group of
its own.  A null id comes after every other id.  Equal rows are copies of each
other.  A very long text is read whole, as a block of its own.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import blocks, checkpointed, utf8
from opinio.llm.words import ALNUM, grams, hashed, mix, prefix, spans_hash

SHINGLE, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.999
COORDINATES, BUCKET, DEPTH, BLOCK = 128, 256, 2, 256
#: Sets of a block where a bucket that no level has split is compared by MinHash bytes (144 bytes a set).
CROWD = 2048
#: A pair at the threshold is estimated this much lower with a probability of about 1e-5 (four standard deviations).
SLACK = 0.15
ROWS_A_FILE = 200_000

_RNG = np.random.default_rng(20)
_A = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_SALT = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def runs_needed(recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold shares a leaf with probability ``recall``:
    at each node it shares a Poisson number of chosen tokens, one on average."""
    survives = 1.0
    for _ in range(depth):
        survives = 1 - math.exp(-survives)
    return math.ceil(math.log(1 - recall) / math.log(1 - survives))


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in order, and how many come before each text (one longer)."""
    words, _, _, counts = hashed(data, offsets, ALNUM, True)
    h, first = grams(words, counts, size)
    text = np.searchsorted(counts, first, side="right") - 1
    n = np.diff(counts)
    short = np.flatnonzero((n > 0) & (n < size))
    h = np.concatenate([h, spans_hash(prefix(words), counts[:-1][short], counts[1:][short])])
    text = np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])) if len(h) else np.zeros(0, bool)
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(n) + 1))


def _described(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class key (a 128-bit hash of the set), set size, MinHash values and their lowest bytes of each text."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets):
            h, at = shingles(data, offsets[a : b + 1], size)
            n = np.diff(at)
            some = np.flatnonzero(n)
            key = np.zeros((b - a, 2), np.uint64)
            values = np.zeros((b - a, COORDINATES), np.uint32)
            if len(some):
                key[some, 0] = np.add.reduceat(mix(h), at[some])
                key[some, 1] = np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at[some])
                for c in range(COORDINATES):
                    values[some, c] = np.minimum.reduceat((h * _A[c] + _B[c]) >> np.uint64(32), at[some])
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in ("id", "t", "t2")], _binary(key), pa.array(n, pa.int64()), _binary(values), _binary(values.astype(np.uint8))],
                ["id", "t", "t2", "class", "n", "values", "bytes"],
            )


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Equally long binary rows as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _children(node: np.ndarray, values: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child nodes of the coordinates that each row's node chooses."""
    chosen_below = np.uint64(int(2**64 / (threshold * COORDINATES)) - 1)
    rows, out = [], []
    for c in range(COORDINATES):
        salted = mix(node + _SALT[c])
        r = np.flatnonzero(salted < chosen_below)
        rows.append(r)
        out.append(mix(salted[r] ^ (values[r, c].astype(np.uint64) + np.uint64(c << 32))))
    return np.concatenate(rows), np.concatenate(out)


def _first_nodes(runs: int, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _matrix(batch.column("values"), np.uint32)
        for run in range(runs):
            rows, node = _children(np.full(len(values), mix(np.array([run + 1], np.uint64))[0]), values, threshold)
            yield pa.RecordBatch.from_arrays([batch.column("class").take(pa.array(rows)), pa.array(node.view(np.int64))], ["class", "node"])


def _next_nodes(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            node = batch.column("node").to_numpy().view(np.uint64)
            rows, node = _children(node, _matrix(batch.column("values"), np.uint32), threshold)
            yield pa.RecordBatch.from_arrays([batch.column("class").take(pa.array(rows)), pa.array(node.view(np.int64))], ["class", "node"])


def _cells(compare: Callable[[pa.Table], pa.RecordBatch], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``compare`` on whole cells: rows come sorted by cell, a batch may end within one."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        last = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if cell[0] != cell[-1] else 0
        if rest and rest[-1].column("cell")[-1].as_py() != int(cell[0]):
            yield compare(pa.Table.from_batches(rest))
            rest = []
        if last:
            yield compare(pa.Table.from_batches([*rest, batch.slice(0, last)]))
            rest = [batch.slice(last)]
        else:
            rest.append(batch)
    if rest:
        yield compare(pa.Table.from_batches(rest))


def _bounds(table: pa.Table) -> tuple[np.ndarray, list[tuple[int, int]]]:
    cell = table.column("cell").to_numpy()
    cuts = np.flatnonzero(np.diff(cell)) + 1
    return cell, list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(cell)], strict=True))


def _alike(least: float, table: pa.Table) -> pa.RecordBatch:
    """Spanning trees of the sets of each cell whose estimated similarity is at least ``least``."""
    keys = table.column("class").to_pylist()
    bytes_ = _matrix(table.column("bytes").combine_chunks(), np.uint8)
    a, b = [], []
    for lo, hi in _bounds(table)[1]:
        open_ = np.arange(lo, hi)
        while len(open_) > 1:
            queue, open_ = [int(open_[0])], open_[1:]
            alike = {keys[queue[0]]}
            while queue and len(open_):
                near = (bytes_[open_] == bytes_[queue.pop()]).sum(axis=1) >= least * COORDINATES
                queue += open_[near].tolist()
                alike.update(keys[k] for k in open_[near].tolist())
                open_ = open_[~near]
            # the least key is the root, so that runs which find the same sets find the same edges
            root = min(alike)
            b += alike - {root}
            a += [root] * (len(alike) - 1)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _with_sets(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets):
            h, at = shingles(data, offsets[a : b + 1], size)
            sets = pa.array([h[at[i] : at[i + 1]].tobytes() for i in range(b - a)], pa.binary())
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([rows.column("told"), sets], ["told", "set"])


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``left`` with sets ``right`` (indexes), from their incidence matrices."""
    out = np.zeros((len(left), len(right)))
    if len(left) * len(right) <= 16:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                out[i, j] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return out
    every, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = many[column] > 1
    column, owner = (np.cumsum(many > 1) - 1)[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    for first in range(0, int((many > 1).sum()), width):
        lo, hi = np.searchsorted(column, [first, first + width])
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - first] = 1
        out += matrix[left] @ matrix[right].T
    return out


def _verified(threshold: float, table: pa.Table) -> pa.RecordBatch:
    """By cell and class: linked texts in the cell, and the least class of its linked sets there."""
    keys, weight = table.column("class").to_pylist(), table.column("texts").to_numpy()
    side, cross = table.column("side").to_numpy(), table.column("cross").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
    links, roots = np.zeros(len(keys), np.int64), list(keys)
    for lo, hi in _bounds(table)[1]:
        # equal rows of a document may have come twice
        index = np.array(list({keys[k]: k for k in range(lo, hi)}.values()))
        if len(index) < 2:
            links[lo:hi] = 0
            continue
        first = index[side[index] == side[index].min()] if cross[lo] else index
        second = np.setdiff1d(index, first) if cross[lo] else index
        local = {int(k): i for i, k in enumerate(index)}
        own = [sets[k] for k in index]
        left, right = np.array([local[k] for k in first.tolist()], int), np.array([local[k] for k in second.tolist()], int)
        if not len(right):
            continue
        n = np.array([len(s) for s in own])
        inter = intersections(own, left, right)
        union = n[left][:, None] + n[right] - inter
        linked = (inter >= threshold * union - 1e-9) & (index[left][:, None] != index[right])
        found = np.zeros(len(index), np.int64)
        found[left] += linked @ weight[index[right]]
        if cross[lo]:
            found[right] += linked.T @ weight[index[left]]
        links[index] = found
        parent = list(range(len(index)))
        for i, row in zip(left.tolist(), linked, strict=True):
            near = right[row]
            labels = {parent[i], *(parent[k] for k in near.tolist())}
            if len(labels) > 1:
                low = min(labels)
                parent = [low if p in labels else p for p in parent]
        least: dict[int, bytes] = {}
        for k, p in enumerate(parent):
            least[p] = min(least.get(p, keys[index[k]]), keys[index[k]])
        for k, p in enumerate(parent):
            roots[index[k]] = least[p]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links), pa.array(roots, pa.binary())], ["class", "links", "root"])


def _written(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` narrow rows, written to the checkpoint folder in as many files as they need."""
    return checkpointed(df.coalesce(rows // ROWS_A_FILE + 4))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): every key with the least key of its component (key, label)."""
    edges = edges.select("a", "b").distinct().persist(StorageLevel.DISK_ONLY)
    n = 2 * edges.count()
    both = _written(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), n)
    edges.unpersist()
    labels = _written(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("b")).select("key", F.least("key", "b").alias("label")), n)
    while True:
        near = both.join(labels, both.a == labels.key).groupBy("b").agg(F.min("label").alias("near"))
        new = _written(labels.join(near, labels.key == near.b).select("key", F.least("label", "near").alias("label"), F.col("label").alias("old")), n)
        if new.where("label <> old").isEmpty():
            return labels
        # a label's own label is nearer to the least one
        up = new.select(F.col("key").alias("up"), F.col("label").alias("top"))
        labels = _written(new.join(up, new.label == up.up).select("key", F.least("label", "top").alias("label")), n)


def _in_cells(rows: DataFrame, size: Column, key: str, block: int) -> DataFrame:
    """``rows`` once for each cell: a bucket of more than ``block`` sets is cut into blocks, and a cell is a pair of them."""
    parts = F.ceil(size / block).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("side", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("other", other)
    low, high = F.least("side", "other"), F.greatest("side", "other")
    return rows.withColumn("cell", F.xxhash64(key, low, high)).withColumn("cross", F.col("side") != F.col("other"))


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD,
                    recall: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """Documents (id, t, t2: hashes of the text, class, n shingles) and classes
    (class, first document, texts, links to other texts, label of its group; empty sets apart)."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.select("id", "text", F.xxhash64("text").alias("t"), F.xxhash64(F.lit(1), "text").alias("t2"))
    kind = own.schema["id"].dataType.simpleString()
    described = own.mapInArrow(partial(_described, size), f"id {kind}, t bigint, t2 bigint, class binary, n bigint, values binary, bytes binary").persist(StorageLevel.DISK_ONLY)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t", "t2")).alias("first")
    classes = described.where("n > 0").groupBy("class").agg(first, F.count(F.lit(1)).alias("texts"), F.min("values").alias("values"), F.min("bytes").alias("bytes")).persist(StorageLevel.DISK_ONLY)

    # 1. chosen paths: leaves of all runs
    node_schema = "class binary, node bigint"
    nodes = classes.select("class", "values").mapInArrow(partial(_first_nodes, runs_needed(recall), threshold), node_schema)
    many = classes.count() * 2 * runs_needed(recall)
    leaves = None
    for level in range(1, DEPTH + 1):
        sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        members = _written(nodes.join(sizes, "node"), many)
        large = members.where(F.col("size") > BUCKET)
        last = level == DEPTH or large.isEmpty()
        own_leaves = members if last else members.where(F.col("size") <= BUCKET)
        leaves = own_leaves if leaves is None else leaves.union(own_leaves)
        if last:
            break
        nodes = large.join(classes.select("class", "values"), "class").select("class", "values", "node").mapInArrow(partial(_next_nodes, threshold), node_schema)

    # 2. sets that look alike, cell by cell; within cut buckets the pairs of different blocks hold all pairs
    in_cells = _in_cells(leaves, F.col("size"), "node", CROWD).where("cross or parts = 1")
    in_cells = in_cells.select("cell", "class").distinct().join(classes.select("class", "bytes"), "class").select("cell", "class", "bytes")
    in_cells = in_cells.repartition("cell").sortWithinPartitions("cell")
    clusters = components(in_cells.mapInArrow(partial(_cells, partial(_alike, threshold - SLACK)), "a binary, b binary"))

    # 3. exact comparison within the clusters
    cluster_size = clusters.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    wanted = clusters.join(cluster_size, "label").withColumnRenamed("key", "class").join(classes.select("class", "first", "texts"), "class")
    told = F.struct("class", "label", "size", "texts")
    wanted = wanted.select(told.alias("told"), F.col("first.t").alias("t"), F.col("first.t2").alias("t2"), F.col("first.id").alias("id_"))
    texts = own.join(wanted, ["t", "t2"]).where(F.col("id").eqNullSafe(F.col("id_"))).select("told", "text")
    sets = texts.mapInArrow(partial(_with_sets, size), f"told {wanted.schema['told'].dataType.simpleString()}, set binary").select("told.*", "set")
    cells = _in_cells(sets, F.col("size"), "label", BLOCK).select("cell", "class", "texts", "side", "cross", "set")
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    verified = cells.mapInArrow(partial(_cells, partial(_verified, threshold)), "class binary, links bigint, root binary").persist(StorageLevel.DISK_ONLY)
    links = verified.groupBy("class").agg(F.sum("links").alias("links"))
    trees = verified.where("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b"))
    groups = components(trees).withColumnRenamed("key", "class")
    out = classes.select("class", "first", "texts").join(links, "class", "left").join(groups, "class", "left")
    return described.select("id", "t", "t2", "class", "n"), out.select(
        "class", "first", "texts", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "class").alias("label")
    )


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: the id, class_id (least id of the texts that
    links connect), n_links (other rows at the threshold or more, copies too),
    set_id (least id with the same shingles) and set_size (rows with them)."""
    described, classes = similar_classes(docs, id_col, text_col, **options)
    heads = classes.groupBy("label").agg(F.min("first").alias("head"))
    told = classes.join(heads, "label").select(
        "class", F.col("head.id").alias("class_id"), F.col("first.id").alias("set_id"), F.col("texts").alias("set_size"), (F.col("links") + F.col("texts") - 1).alias("n_links")
    )
    out = described.select("id", F.when(F.col("n") > 0, F.col("class")).alias("class")).join(told, "class", "left")
    one = F.lit(1).cast("long")
    alone = F.col("class").isNull()
    return out.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", one - 1).alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("set_id")).alias("set_id"), F.coalesce("set_size", one).alias("set_size"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, with the first document of each group (and every one without words)."""
    described, classes = similar_classes(docs, id_col, text_col, **options)
    heads = classes.groupBy("label").agg(F.min("first").alias("head")).select("head.id", "head.t", "head.t2")
    empty = described.where("n = 0").select("id", "t", "t2").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit(1), text).alias("t2"))
    same = (F.col("r.t") == F.col("h.t")) & (F.col("r.t2") == F.col("h.t2")) & F.col("r.id").eqNullSafe(F.col("h.id"))
    kept = rows.alias("r").join(heads.alias("h"), same).groupBy("r.id", "r.t", "r.t2").agg(F.min("r.row").alias("row"))
    return kept.select("row.*").union(rows.alias("r").join(empty.alias("h"), same, "left_semi").select("row.*"))
