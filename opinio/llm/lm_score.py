"""LM scoring (10): a causal self-attention model trained in numpy on subword
ids, whose overlapping context windows score each token once with batched masked
attention, interpolated with word counts of the whole training corpus.

A text is its words (runs of anything but white space, A-Z folded) and one end.
Each word is encoded on its own, after a space, by a public byte-level BPE; a
subword that begins with a space, or the end, thereby ends the word before it.
The network (one layer, one head, RMS norm) reads the ids before, each by an
embedding of its own, and predicts a class of ids: the most frequent ids have
classes of their own, the others share classes by what stands beside them, within
which their frequency decides.  Windows of
``CONTEXT`` ids start every ``STRIDE`` ids; a window scores the ids that no
earlier one scored, so every id but the first few of a text has at least
``CONTEXT - STRIDE`` ids before it.

    p(word) = share * c / N + (1 - share) * p_network(word | ids before)

c counts the word in all training texts, N all their tokens.  p_network is the
product of the word's subwords, given that a word begins and until one ends, so
both parts, and the mixture, are distributions over words.  ``share`` is fitted by
expectation maximisation on texts held back from the network's training, with
their own occurrences taken out of the counts.

The counts of words and ids, and so the classes and the frequencies within them,
cover every training text.  The network begins on a bounded sample of distinct
texts (``sample_chars`` expected) on the driver; then each task trains it on all
texts of its partition, and the mean of the tasks' weights is the model (so scores
depend a little on how the table is split).  Counting combines words per block and task
before the shuffle.  The words at or above a count that at most ``FREQUENT`` words
reach are broadcast; each occurrence of another word is a narrow row (word hash,
network probability) that is joined with the counts and summed by document.

Defined cases: null counts as the empty text: one token, the end.  Without any
training text all counts are 0, and base and network are uniform.  Words are
told apart by a 64-bit hash.  A very long text is encoded whole by one task and scored in
as many windows as it has.  Repeated rows are scored each; as training texts
they count each.  With a single training text nothing is held back and ``share``
is 0.5.  Other columns are not read.
"""

from __future__ import annotations

import base64
import copy
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.bpe import read_ranks
from opinio.llm.common import blocks, utf8
from opinio.llm.words import _LOWER, NOT_SPACE, hashed, mix
from opinio.sources.storage import scratch_path

CONTEXT, STRIDE, SIZE, HEADS, INNER = 32, 24, 24, 1, 32
OWN_CLASSES, SHARED_CLASSES = 160, 24
FREQUENT = 1_000_000
#: Hash of the end, as a word.
END = int(mix(np.array([0xE0F], np.uint64)).view(np.int64)[0])
#: Words that a worker remembers with their ids; windows that are scored at once.
_REMEMBERED, _BATCH = 300_000, 48
#: Exponents stay below this in training and scoring: weights are scaled down to it.
LIMIT = 60.0


class Subwords(dict):
    """Ids of words (bytes, A-Z folded) as little-endian 16-bit integers; encodes on first use."""

    def __init__(self, rank_file: bytes, pattern: str):
        super().__init__()
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        self.ranks, self.pattern = ranks, pattern
        self.end = len(ranks)
        self.begins = np.zeros(self.end + 1, bool)
        self.begins[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.begins[self.end] = True

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("words", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    def __missing__(self, word: bytes) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(" " + word.decode("utf-8", "replace")), "<u2").tobytes()
        if len(self) >= _REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def texts(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts, each ended by the end; ids of each word (ends are words too); words of each text."""
        parts, end = [], np.array([self.end], "<u2").tobytes()
        sizes, words = [], []
        for body in bodies:
            ids = list(map(self.__getitem__, body.translate(_FOLD).split()))
            ids.append(end)
            parts += ids
            sizes += map(len, ids)
            words.append(len(ids))
        return np.frombuffer(b"".join(parts), "<u2").astype(np.int64), np.array(sizes, np.int64) // 2, np.array(words, np.int64)

    def stored(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same from a column of texts that are encoded already (see ``with_ids``): a word is the ids from one that begins a word to the next."""
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 2
        ids = np.frombuffer(column.buffers()[2], "<u2")[offsets[0] : offsets[-1]].astype(np.int64)
        begins = self.begins[ids]
        first = np.flatnonzero(begins)
        # every text has an end, so none is empty
        return ids, np.diff(np.append(first, len(ids))), np.add.reduceat(begins.astype(np.int64), offsets[:-1] - offsets[0])


_FOLD = bytes(_LOWER)


@dataclass
class Classes:
    """Class of each id, its log-probability within the class, which classes begin words, and how many (the first) hold one id."""

    of: np.ndarray
    within: np.ndarray
    begins: np.ndarray
    own: int


def own_classes(counts: np.ndarray) -> np.ndarray:
    """Ids that have classes of their own: the most frequent ones and the end."""
    own = np.argsort(-counts, kind="stable")[:OWN_CLASSES]
    return own if len(counts) - 1 in own else np.append(own[:-1], len(counts) - 1)


def neighbours(ids: np.ndarray, own: np.ndarray, size: int) -> np.ndarray:
    """What stands before and after each id without an own class: id * 2 * len(own) + column, once per occurrence."""
    column = np.full(size, -1)
    column[own] = np.arange(len(own))
    out = []
    for a, b, more in ((ids[1:], ids[:-1], 0), (ids[:-1], ids[1:], len(own))):
        seen = (column[a] < 0) & (column[b] >= 0)
        out.append(a[seen] * (2 * len(own)) + column[b[seen]] + more)
    return np.concatenate(out)


def make_classes(ids: np.ndarray, begins: np.ndarray, seed: int = 2) -> Classes:
    """Classes from the ids of one sequence."""
    counts = np.bincount(ids, minlength=len(begins)).astype(float)
    own = own_classes(counts)
    return classes_of_counts(counts, own, *np.unique(neighbours(ids, own, len(begins)), return_counts=True), begins, seed)


def classes_of_counts(counts: np.ndarray, own: np.ndarray, beside_key: np.ndarray, beside_n: np.ndarray, begins: np.ndarray, seed: int = 2) -> Classes:
    """Classes from the counts of ids and of ``neighbours``: ``own`` ids have one each; the others share
    classes with ids that occur beside the same ids (k-means), which sets languages and word parts apart."""
    order = np.argsort(-counts, kind="stable")
    of = np.full(len(counts), -1)
    of[own] = np.arange(len(own))
    rest = order[(of[order] < 0) & (counts[order] > 0)]
    beside = np.zeros((len(counts) if len(rest) else 0, 2 * len(own)), np.float32)
    if len(rest):
        beside.reshape(-1)[beside_key] = beside_n
    rng = np.random.default_rng(seed)
    n = len(own)
    for kind in (True, False):
        some = rest[begins[rest] == kind]
        if len(some):
            x = np.sqrt(beside[some] / np.maximum(beside[some].sum(axis=1, keepdims=True), 1))
            weight = counts[some]
            centres = x[rng.choice(len(some), min(SHARED_CLASSES, len(some)), replace=False, p=weight / weight.sum())]
            for _ in range(15):
                nearest = (x @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
                for k in range(len(centres)):
                    if (nearest == k).any():
                        centres[k] = np.average(x[nearest == k], axis=0, weights=weight[nearest == k])
            of[some] = n + nearest
        # ids that the texts lack
        of[(of < 0) & (begins == kind)] = n + SHARED_CLASSES
        n += SHARED_CLASSES + 1
    total = np.bincount(of, counts + 0.05, n)
    starts = np.zeros(n, bool)
    starts[of[begins]] = True
    return Classes(of, np.log((counts + 0.05) / total[of]), starts, len(own))


def _norm(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r = 1 / np.sqrt(np.einsum("...i,...i->...", x, x)[..., None] / x.shape[-1] + 1e-5)
    return x * r, r


def _norm_back(d: np.ndarray, y: np.ndarray, r: np.ndarray) -> np.ndarray:
    return r * (d - y * (np.einsum("...i,...i->...", d, y)[..., None] / y.shape[-1]))


def _sum_rows(values: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indexes and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    begin = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    return index[begin], np.add.reduceat(values[order], begin, axis=0)


class Network:
    """Causal self-attention over ids, with classes of ids as output.  An id's embedding is that of
    its class (``e``) and, if it shares the class, an offset of its own (``offset``)."""

    def __init__(self, classes: int, seed: int = 5, ids: int = 0):
        rng = np.random.default_rng(seed)
        f = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.w = {
            "e": f(classes, SIZE, s=0.5), "p": f(CONTEXT, SIZE, s=0.1), "qkv": f(SIZE, 3 * SIZE, s=SIZE**-0.5), "o": f(SIZE, SIZE, s=SIZE**-0.5),
            "f1": f(SIZE, INNER, s=SIZE**-0.5), "b1": np.zeros(INNER, np.float32), "f2": f(INNER, SIZE, s=INNER**-0.5),
            "y": f(SIZE, classes, s=0.1), "by": np.zeros(classes, np.float32),
        }
        self.mask = np.tri(CONTEXT, dtype=np.float32)
        self.offset = np.zeros((ids, SIZE), np.float32)

    def bound(self) -> None:
        """Scales weights down where exponents could exceed ``LIMIT``: a normed state has length sqrt(SIZE)."""
        q, k = (self.w["qkv"][:, i * SIZE : (i + 1) * SIZE] for i in (0, 1))
        score = np.linalg.norm(q, 2) * np.linalg.norm(k, 2) * SIZE * (SIZE // HEADS) ** -0.5
        if score > LIMIT:
            self.w["qkv"][:, : 2 * SIZE] *= np.float32((LIMIT / score) ** 0.5)
        logit = np.linalg.norm(self.w["y"], axis=0).max() * SIZE**0.5 + np.abs(self.w["by"]).max()
        if logit > LIMIT:
            self.w["y"] *= np.float32(LIMIT / logit)
            self.w["by"] *= np.float32(LIMIT / logit)

    def hidden(self, ids: np.ndarray, inputs: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
        """States (B, T, SIZE) that predict the next class, and what their gradients need;
        ``ids`` are classes, ``inputs`` their embeddings if they are not those of the classes alone."""
        w, (b, t) = self.w, ids.shape
        x0 = (w["e"][ids] if inputs is None else inputs) + w["p"][:t]
        a, ra = _norm(x0)
        q, k, v = (a @ w["qkv"]).reshape(b, t, 3, HEADS, SIZE // HEADS).transpose(2, 0, 3, 1, 4)
        # no shift before the exponentials: norms bound the scores (see LIMIT)
        s = (q * np.float32((SIZE // HEADS) ** -0.5)) @ k.transpose(0, 1, 3, 2)
        np.exp(s, out=s)
        s *= self.mask[:t, :t]
        s /= np.einsum("...i->...", s)[..., None] + np.float32(1e-30)
        z = (s @ v).transpose(0, 2, 1, 3).reshape(b, t, SIZE)
        x1 = x0 + z @ w["o"]
        c, rc = _norm(x1)
        g = np.maximum(c @ w["f1"] + w["b1"], 0)
        x2 = x1 + g @ w["f2"]
        y, ry = _norm(x2)
        return y, (ids, a, ra, q, k, v, s, z, c, rc, g, y, ry)

    def gradients(self, dy: np.ndarray, state: tuple) -> dict:
        """Of all weights but the output's, and of the inputs (``x``), from those of the states."""
        ids, a, ra, q, k, v, s, z, c, rc, g, y, ry = state
        w, (b, t) = self.w, ids.shape
        flat = lambda x: x.reshape(-1, x.shape[-1])
        dx2 = _norm_back(dy, y, ry)
        out = {"f2": flat(g).T @ flat(dx2)}
        dg = (dx2 @ w["f2"].T) * (g > 0)
        out["f1"], out["b1"] = flat(c).T @ flat(dg), flat(dg).sum(axis=0)
        dx1 = dx2 + _norm_back(dg @ w["f1"].T, c, rc)
        out["o"] = flat(z).T @ flat(dx1)
        dz = (dx1 @ w["o"].T).reshape(b, t, HEADS, SIZE // HEADS).transpose(0, 2, 1, 3)
        ds = dz @ v.transpose(0, 1, 3, 2)
        dv = s.transpose(0, 1, 3, 2) @ dz
        ds -= np.einsum("...i,...i->...", ds, s)[..., None]
        ds *= s
        ds *= np.float32((SIZE // HEADS) ** -0.5)
        dqkv = np.stack([ds @ k, ds.transpose(0, 1, 3, 2) @ q, dv]).transpose(1, 3, 0, 2, 4).reshape(b, t, 3 * SIZE)
        out["qkv"] = flat(a).T @ flat(dqkv)
        dx0 = dx1 + _norm_back(dqkv @ w["qkv"].T, a, ra)
        out["p"] = np.zeros_like(w["p"])
        out["p"][:t] = dx0.sum(axis=0)
        out["x"] = flat(dx0)
        out["e"] = np.zeros_like(w["e"])
        found, sums = _sum_rows(out["x"], ids.reshape(-1))
        out["e"][found] = sums
        return out

    def loss(self, ids: np.ndarray, targets: np.ndarray, used: np.ndarray, inputs: np.ndarray | None = None) -> tuple[float, dict]:
        """Mean negative log-probability of the used target classes, and the gradients."""
        y, state = self.hidden(ids, inputs)
        rows = y[used]
        z = rows @ self.w["y"] + self.w["by"]
        # no shift here either (see LIMIT)
        p = np.exp(z, out=z)
        p /= np.einsum("ij->i", p)[:, None]
        want = targets[used]
        at = np.arange(len(want))
        value = float(-np.log(p[at, want] + 1e-30).mean())
        p[at, want] -= 1
        dy = np.zeros_like(y)
        dy[used] = (p @ self.w["y"].T) / len(want)
        return value, self.gradients(dy, state) | {"y": rows.T @ p / len(want), "by": p.mean(axis=0)}


def context_windows(size: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences of ``size`` predictions: sequence, first prediction, and predictions already scored, of each window."""
    many = np.where(size > 0, np.maximum(-(-(size - CONTEXT) // stride), 0) + 1, 0)
    owner = np.repeat(np.arange(len(size)), many)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return owner, inside * stride, np.where(inside > 0, CONTEXT - stride, 0)


@dataclass
class LanguageModel:
    rank_file: bytes
    pattern: str
    classes: Classes
    network: Network
    share: float = 0.5
    _subwords: Subwords | None = field(default=None, repr=False)
    _inputs: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_subwords": None, "_inputs": None}

    @property
    def subwords(self) -> Subwords:
        if self._subwords is None:
            self._subwords = Subwords(self.rank_file, self.pattern)
        return self._subwords

    @property
    def inputs(self) -> np.ndarray:
        """Embedding of every id."""
        if self._inputs is None:
            self._inputs = self.network.w["e"][self.classes.of] + self.network.offset
        return self._inputs

    def word_logs(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Natural log-probability of every word of the texts by the network (each text's end last), and words of each text."""
        return self.encoded_logs(*self.subwords.texts(bodies))

    def encoded_logs(self, ids: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of encoded texts."""
        classes = self.classes.of[ids]
        first_word = np.cumsum(sizes) - sizes
        text_end = np.cumsum(np.add.reduceat(sizes, np.cumsum(words) - words)) if len(words) else np.zeros(0, np.int64)
        text_first = np.append(0, text_end[:-1])
        owner, begin, scored = context_windows(text_end - text_first)
        log_id, log_begin = np.empty(len(ids), np.float32), np.empty(len(ids), np.float32)
        # an id's window shows the ids before it; before the first stands an end
        shown = np.empty(len(ids), np.int64)
        shown[1:] = ids[:-1]
        shown[text_first] = self.subwords.end
        length = np.minimum(CONTEXT, (text_end - text_first)[owner] - begin)
        order = np.lexsort((scored, length))
        both = np.stack([np.ones(len(self.classes.begins)), self.classes.begins], axis=1).astype(np.float32)
        w = self.network.w
        for a in range(0, len(order), _BATCH):
            some = order[a : a + _BATCH]
            longest = int(length[some].max())
            whole = int(length[some[0]]) == longest and scored[some].min() == scored[some].max()  # windows of one shape
            place = text_first[owner[some]][:, None] + begin[some][:, None] + np.arange(longest)
            column = np.arange(longest)
            used = None if whole else (column >= scored[some][:, None]) & (column < length[some][:, None])
            read = shown[place if whole else np.minimum(place, len(ids) - 1)]
            y, _ = self.network.hidden(read, self.inputs[read])
            from_ = int(scored[some[0]])
            at = place[:, from_:].reshape(-1) if whole else place[used]
            z = (y[:, from_:].reshape(-1, SIZE) if whole else y[used]) @ w["y"]
            z += w["by"]
            own = z[np.arange(len(at)), classes[at]]
            np.exp(z, out=z)
            total = np.log(z @ both)
            log_id[at] = own - total[:, 0]
            log_begin[at] = total[:, 1] - total[:, 0]
        log_id += self.classes.within[ids]
        # a word: its ids, given that a word begins, until the next begins (the end stays the end)
        by_word = np.add.reduceat(log_id, first_word, dtype=np.float64) - log_begin[first_word]
        last = np.cumsum(words) - 1
        following = np.append(log_begin[first_word[1:]], 0).astype(np.float64)
        following[last] = 0
        return by_word + following, words


class Trainer:
    """Trains a network, a batch of windows at a time."""

    def __init__(self, subwords: Subwords, classes: Classes, network: Network, seed: int = 11):
        self.subwords, self.classes, self.net, self.rng = subwords, classes, network, np.random.default_rng(seed)
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.w.items()}
        self.squares = np.full((len(network.offset), 1), 1e-8, np.float32)
        self.step = 0

    def read(self, ids: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> None:
        """Takes up encoded texts (see ``Subwords.texts``)."""
        end = np.cumsum(np.add.reduceat(sizes, np.cumsum(words) - words))
        first = np.append(0, end[:-1])
        self.shown, self.target = np.append(0, ids[:-1]), self.classes.of[ids]
        self.shown[first] = self.subwords.end
        owner, begin, _ = context_windows(end - first, CONTEXT)  # each id is predicted once
        self.start, self.length = first[owner] + begin, np.minimum(CONTEXT, (end - first)[owner] - begin)

    def train(self, some: np.ndarray, rate: float) -> int:
        """One step on some of the windows; the number of ids predicted."""
        self.step += 1
        place = np.minimum(self.start[some][:, None] + np.arange(CONTEXT), len(self.shown) - 1)
        used = np.arange(CONTEXT) < self.length[some][:, None]
        ids, net = self.shown[place], self.net
        shown = self.classes.of[ids]
        _, g = net.loss(shown, self.target[place], used, net.w["e"][shown] + net.offset[ids])
        dx = g.pop("x")
        for k, v in g.items():
            m, s = self.moments[k]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            net.w[k] -= (rate * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-8)).astype(np.float32)
        shared = (used & (shown >= self.classes.own)).reshape(-1)
        if shared.any():
            found, sums = _sum_rows(dx[shared], ids.reshape(-1)[shared])
            self.squares[found] += (sums * sums).mean(axis=1, keepdims=True)
            net.offset[found] -= 5 * rate * sums / np.sqrt(self.squares[found])
        if rate > 0.003 or self.step % 4 == 0:  # at small rates four steps take little of the room that LIMIT leaves
            net.bound()
        return int(used.sum())


def train_network(subwords: Subwords, bodies: list[bytes], steps: int, batch: int = 64, seed: int = 11, classes: Classes | None = None) -> tuple[Classes, Network]:
    """A network of some texts; their own ids make the classes if none are given."""
    ids, sizes, words = subwords.texts(bodies)
    classes = make_classes(ids, subwords.begins) if classes is None else classes
    net = Network(len(classes.begins), seed, len(classes.of))
    if not len(ids):
        return classes, net
    net.w["by"][:] = np.log(np.bincount(classes.of[ids], minlength=len(classes.begins)) / len(ids) + 1e-6)
    trainer = Trainer(subwords, classes, net, seed)
    trainer.read(ids, sizes, words)
    for step in range(1, steps + 1):
        trainer.train(trainer.rng.integers(0, len(trainer.start), batch), 0.01 * min(1, step / 20) * (1 - 0.95 * step / steps))
    net.bound()
    return classes, net


def _encoded(subwords: Subwords, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of encoded texts (see ``Subwords.texts``), from the column ids or else the column text."""
    for batch in batches:
        if "ids" in batch.schema.names:
            column = batch.column("ids")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            for a, b in blocks(offsets.astype(np.int64)):
                yield subwords.stored(column.slice(a, b - a))
        else:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                yield subwords.texts([data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)])


def _with_ids(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    subwords, text_col, ids_col = Subwords(*sent.value[:2]), *sent.value[2:]
    for batch in batches:
        data, offsets = utf8(batch.column(text_col))
        for a, b in blocks(offsets):
            ids, sizes, words = subwords.texts([data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)])
            end = 2 * np.cumsum(np.add.reduceat(sizes, np.cumsum(words) - words))
            column = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(np.append(0, end).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))])
            yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, column], [*batch.schema.names, ids_col])


def with_ids(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text and its end (little-endian 16-bit integers), written once to the shared
    checkpoint folder and read from there: counting, training and scoring need not encode again."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((read_ranks(rank_path), pattern, text_col, ids_col))
    path = scratch_path(spark, "lm-ids")
    docs.mapInArrow(partial(_with_ids, sent), T.StructType([*docs.schema, T.StructField(ids_col, T.BinaryType())])).write.parquet(path)
    return spark.read.parquet(path)


def _count_ids(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's texts: how often each id occurs, or each key of ``neighbours`` if own classes are given."""
    subwords, own = Subwords(*sent.value[:2]), sent.value[2]
    size = subwords.end + 1
    n = np.zeros(size * (1 if own is None else 2 * len(own)), np.int64)
    for ids, _, _ in _encoded(subwords, batches):
        if own is None:
            n += np.bincount(ids, minlength=size)
        else:
            key, many = np.unique(neighbours(ids, own, size), return_counts=True)
            n[key] += many
    found = np.flatnonzero(n)
    for a in range(0, len(found), 1 << 16):
        some = found[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], ["k", "n"])


def _texts(docs: DataFrame, text_col: str, ids_col: str | None) -> DataFrame:
    """The one column that tasks encode, or that is encoded."""
    return docs.select(F.col(text_col).alias("text") if ids_col is None else F.col(ids_col).alias("ids"))


def corpus_classes(docs: DataFrame, rank_file: bytes, pattern: str, text_col: str = "text", ids_col: str | None = None) -> Classes:
    """Classes by the ids of all texts of ``docs``: counted in one pass, what stands beside them in a second."""
    subwords, spark = Subwords(rank_file, pattern), docs.sparkSession
    texts = _texts(docs, text_col, ids_col)

    def counted(own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        sent = spark.sparkContext.broadcast((rank_file, pattern, own))
        found = texts.mapInArrow(partial(_count_ids, sent), "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
        return found.column("k").to_numpy(), found.column("n").to_numpy()

    counts = np.zeros(subwords.end + 1)
    k, n = counted(None)
    counts[k] = n
    own = own_classes(counts)
    return classes_of_counts(counts, own, *counted(own), subwords.begins)


_WEIGHTS = [f"x{i}" for i in range(SIZE)]


def _train_part(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trains on a task's texts; a row for each offset (k: id, n: its occurrences) and each SIZE numbers of the other weights (k < 0, n: ids)."""
    model: LanguageModel = sent.value
    net = copy.deepcopy(model.network)  # a worker runs several tasks on one broadcast value
    trainer, many, seen = Trainer(model.subwords, model.classes, net), 0, np.zeros(len(net.offset), np.int64)
    for encoded in _encoded(model.subwords, batches):
        trainer.read(*encoded)
        order = trainer.rng.permutation(len(trainer.start))
        for a in range(0, len(order), 64):
            many += trainer.train(order[a : a + 64], 0.002 * min(1, (trainer.step + 1) / 20) / (1 + trainer.step / 200) ** 0.5)
        seen += np.bincount(trainer.shown, minlength=len(seen))
    if many:
        net.bound()
        seen[model.classes.of < model.classes.own] = 0
        ids = np.flatnonzero(seen)
        dense = np.concatenate([net.w[k].reshape(-1) for k in sorted(net.w)])
        dense = np.pad(dense, (0, -len(dense) % SIZE)).reshape(-1, SIZE)
        keys = np.append(ids, -1 - np.arange(len(dense))).astype(np.int32)
        rows = np.concatenate([net.offset[ids], dense])
        n = np.append(seen[ids], np.full(len(dense), many)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], ["k", "n", *_WEIGHTS])


def train_everywhere(texts: DataFrame, model: LanguageModel) -> Network:
    """The model's network after each task has trained it on its own texts: the mean of the tasks' weights by
    ids trained on, of each id's offset by the id's occurrences."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    parts = texts.mapInArrow(partial(_train_part, sent), "k int, n bigint, " + ", ".join(f"{x} float" for x in _WEIGHTS))
    mean = parts.groupBy("k").agg(*((F.sum(F.col(x) * F.col("n").cast("double")) / F.sum("n")).alias(x) for x in _WEIGHTS)).toArrow()
    net = model.network
    if mean.num_rows:
        k = mean.column("k").to_numpy()
        rows = np.stack([mean.column(x).to_numpy() for x in _WEIGHTS], axis=1).astype(np.float32)
        net.offset[k[k >= 0]] = rows[k >= 0]
        flat, at = rows[k < 0][np.argsort(-k[k < 0])].reshape(-1), 0
        for name in sorted(net.w):
            shape, size = net.w[name].shape, net.w[name].size
            net.w[name], at = flat[at : at + size].reshape(shape).copy(), at + size
        net.bound()
    return net


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets, 1 << 22):
            words = np.concatenate([hashed(data, offsets[c : d + 1], NOT_SPACE, True)[0] for c, d in _within(offsets, a, b)])
            h, n = np.unique(words, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(h.view(np.int64), END)), pa.array(np.append(n, b - a))], ["h", "n"])


def _within(offsets: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int]]:
    return ((a + c, a + d) for c, d in blocks(offsets[a : b + 1]))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Count of every word and of the end (h: 64-bit hash, n) in the texts of ``docs``."""
    return docs.select(F.col(text_col).alias("text")).mapInArrow(_count_words, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Frequent:
    """Words of ``least`` occurrences or more, by sorted hash, and the corpus totals."""

    h: np.ndarray
    n: np.ndarray
    least: int
    tokens: int
    words: int


def frequent_words(counts: DataFrame, limit: int = FREQUENT) -> Frequent:
    by_size = {r.k: r for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()}
    least, room = 1, limit
    for k in sorted(by_size, reverse=True):
        room -= by_size[k].words
        if room < 0:
            least = 2 << k
            break
    top = counts.where(F.col("n") >= least).toArrow()
    h, n = top.column("h").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(h)
    return Frequent(h[order], n[order], least, sum(r.tokens for r in by_size.values()), sum(r.words for r in by_size.values()))


def _piece_at(t: Column, text: Column, most: int) -> Column:
    """Where the piece of a text begins that a sample takes: anywhere, by the text's hash; at 1 for texts of ``most`` characters or fewer."""
    return (F.pmod(F.xxhash64(t), F.greatest(F.char_length(text) - most, F.lit(0)) + 1) + 1).cast("int")


def draw_texts(docs: DataFrame, chars: int, text_col: str = "text") -> list[tuple[int, bytes]]:
    """Hash of distinct texts and a piece of each (the whole text up to an eighth of ``chars``, else so much of it from a place that
    its hash gives), of about ``chars`` characters together (all, if there are fewer); copies count once."""
    own = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(F.xxhash64("text").alias("t"), "text")
    most = max(chars // 8, 1)
    sizes = own.select("t", F.least(F.char_length("text"), F.lit(most)).alias("n")).groupBy("t").agg(F.max("n").alias("n")).persist(StorageLevel.DISK_ONLY)
    step = (sizes.agg(F.sum("n")).first()[0] or 0) // chars + 1
    drawn = {r.t: r.n for r in sizes.where(F.pmod("t", F.lit(step)) == 0).collect()}
    if step > 1 and (len(drawn) < 16 or sum(drawn.values()) < chars // 2):
        # few long texts: the next by hash
        for r in sizes.orderBy("t").limit(64).collect():
            if len(drawn) < 16 or sum(drawn.values()) < chars // 2:
                drawn[r.t] = r.n
    sizes.unpersist()
    wanted = docs.sparkSession.createDataFrame(pa.table({"t": pa.array(sorted(drawn), pa.int64())}))
    piece = F.col("text").substr(_piece_at(F.col("t"), F.col("text"), most), F.lit(most))
    pieces = own.join(F.broadcast(wanted), "t", "left_semi").select("t", piece.alias("text")).distinct()
    return sorted((r.t, r.text.encode()) for r in pieces.collect())


def _without_pieces(docs: DataFrame, drawn: list[int], chars: int, rank_path: str, pattern: str, text_col: str, ids_col: str | None) -> DataFrame:
    """The texts of ``docs`` (as ``_texts``) without the pieces that ``draw_texts`` took of the drawn ones; what stands before and after a piece stays."""
    spark, most = docs.sparkSession, max(chars // 8, 1)
    back = F.broadcast(spark.createDataFrame(pa.table({"t": pa.array(drawn, pa.int64())})))
    own = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), *([F.col(ids_col).alias("ids")] if ids_col else [])).withColumn("t", F.xxhash64("text"))
    begin = _piece_at(F.col("t"), F.col("text"), most)
    rest = own.where(F.char_length("text") > most).join(back, "t", "left_semi").select(
        F.concat(F.col("text").substr(F.lit(1), begin - 1), F.lit(" "), F.col("text").substr(begin + most, F.char_length("text"))).alias("text")
    )
    if ids_col:
        rest = with_ids(rest, rank_path, pattern)
    return _texts(own.join(back, "t", "left_anti").unionByName(rest, allowMissingColumns=True), "text", ids_col and "ids")


def fit(docs: DataFrame, counts: DataFrame, frequent: Frequent, rank_path: str, pattern: str, text_col: str = "text", sample_chars: int = 3_000_000, steps: int = 1500, ids_col: str | None = None) -> LanguageModel:
    """The model of ``docs`` (training texts): classes by the ids of all texts; the network begun on a sample,
    from which the share's pieces are held back, then trained on everything else; ``ids_col`` as made by ``with_ids``."""
    rank_file = read_ranks(rank_path)
    subwords = Subwords(rank_file, pattern)
    drawn = draw_texts(docs, sample_chars, text_col)
    drawn = [drawn[i] for i in np.random.default_rng(1).permutation(len(drawn))]
    some = max(len(drawn) // 8, min(len(drawn) - 1, 1))
    held, bodies = [b for _, b in drawn[:some]], [b for _, b in drawn[some:]]
    classes = corpus_classes(docs, rank_file, pattern, text_col, ids_col)
    model = LanguageModel(rank_file, pattern, *train_network(subwords, bodies, steps if bodies else 0, classes=classes))
    if bodies:
        model.network = train_everywhere(_without_pieces(docs, [t for t, _ in drawn[:some]], sample_chars, rank_path, pattern, text_col, ids_col), model)
    if held:
        logs, _ = model.word_logs(held)
        h = np.concatenate([np.append(hashed(*utf8(pa.array([b.decode()])), NOT_SPACE, True)[0].view(np.int64), END) for b in held])
        spark = docs.sparkSession
        wanted = spark.createDataFrame(pa.table({"h": np.unique(h)}))
        found = counts.join(wanted, "h").toArrow()
        n = dict(zip(found.column("h").to_pylist(), found.column("n").to_pylist(), strict=True))
        own_n = dict(zip(*(x.tolist() for x in np.unique(h, return_counts=True)), strict=True))
        unigram = np.array([max(n.get(x, 0) - own_n[x], 0) for x in h.tolist()]) / max(frequent.tokens, 1)
        p, share = np.exp(logs), 0.5
        for _ in range(40):
            a, b = share * unigram, (1 - share) * p
            share = float(np.clip((a / np.maximum(a + b, 1e-300)).mean(), 0.01, 0.99))
        model.share = share
    return model


def score(docs: DataFrame, counts: DataFrame, frequent: Frequent, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = (), ids_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep``, n_tokens, n_known, train_tokens, base_score and score."""
    sent = docs.sparkSession.sparkContext.broadcast((model, frequent))
    row = F.struct(F.col(id_col).alias(id_col), *keep)
    own = docs.select(F.monotonically_increasing_id().alias("at"), row.alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *([F.col(ids_col).alias("ids")] if ids_col else []))
    schema = f"at bigint, row {own.schema['row'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base double, score double, rare array<struct<h:bigint,p:float>>"
    scored = own.mapInArrow(partial(_score, sent), schema).persist(StorageLevel.DISK_ONLY)
    scored.count()  # computed once, before two branches of the result read it at the same time
    rare = scored.select("at", F.explode("rare").alias("r")).select("at", "r.h", F.col("r.p").cast("double").alias("p"))
    c = F.coalesce(F.col("n"), F.lit(0))
    mixed = F.when(c == 0, F.col("p") + float(np.log10(1 - model.share))).otherwise(
        F.log10(c * (model.share / max(frequent.tokens, 1)) + (1 - model.share) * F.pow(F.lit(10.0), "p"))
    )
    sums = (
        rare.join(counts.where(F.col("n") < frequent.least), "h", "left").groupBy("at")
        .agg(F.sum(F.log10(c + 1)).alias("more_base"), F.sum((c > 0).cast("long")).alias("more_known"), F.sum(mixed).alias("more_score"))
    )
    zero = F.lit(0)
    per_token = float(np.log10(frequent.tokens + frequent.words + 1))
    return scored.join(sums, "at", "left").select(
        "row.*", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(frequent.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )


def _score(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, frequent = sent.value
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets):
            h, _, _, counts = hashed(data, offsets[a : b + 1], NOT_SPACE, True)
            h = np.insert(h.view(np.int64), counts[1:], END)
            logs, words = model.encoded_logs(*model.subwords.stored(batch.column("ids").slice(a, b - a))) if "ids" in batch.schema.names else model.word_logs([data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)])
            text = np.repeat(np.arange(b - a), words)
            at = np.minimum(np.searchsorted(frequent.h, h), max(len(frequent.h) - 1, 0))
            known = frequent.h[at] == h if len(frequent.h) else np.zeros(len(h), bool)
            n = np.where(known, frequent.n[at] if len(frequent.h) else 0, 0)
            mixed = np.log10(np.maximum(model.share * n / max(frequent.tokens, 1) + (1 - model.share) * np.exp(logs), 1e-300))
            sums = [np.bincount(text[known], x[known], b - a).astype(float) for x in (np.ones(len(h)), np.log10(n + 1.0), mixed)]
            other = ~known
            rare = pa.StructArray.from_arrays([pa.array(h[other]), pa.array((logs[other] / np.log(10)).astype(np.float32))], ["h", "p"])
            begin = np.append(0, np.cumsum(np.bincount(text[other], minlength=b - a))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("at").slice(a, b - a), batch.column("row").slice(a, b - a), pa.array(words), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                 pa.ListArray.from_arrays(pa.array(begin), rare)],
                ["at", "row", "n_tokens", "n_known", "base", "score", "rare"],
            )
