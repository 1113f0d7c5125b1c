"""Toxicity (6): a bidirectional gated recurrent network with attention pooling
over character and word inputs, trained in numpy, scoring all overlapping
windows of a text.

A word's input is the embedding of its hash next to the mean of the embeddings
of its character n-grams (on UTF-8 bytes; those at the word's start are marked).
A GRU reads each window of ``WINDOW`` words in both directions, attention pools
the states, one unit gives the window's logit.  A text's logit is that of its
most toxic window; two constants, fitted on rows held back from training, turn
it into a probability.  Labels are sampled at different rates, which the second
constant takes back, so that a score means the same at any number of labels.

Labels belong to whole texts, so a toxic text's windows are trained as a bag
(one minus the product of the windows' complements) and windows of a clean text,
at most eight an epoch and others each time, as negative.  Training takes a bounded sample of labelled rows
(``sample_rows`` of each label: about so many, at most twice as many expected,
taken by a hash of the id) and runs on the driver; the network has a fixed
size and is broadcast.  Scoring is a narrow pass over whole texts.

Defined cases: null, empty and word-less texts have no window and score 0.
Without a toxic and a clean labelled row every text scores 0.  Null labels teach
nothing; all windows of a very long text are scored; repeated rows stay; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import blocks, utf8
from opinio.llm.words import _BYTE, _LOWER, ALNUM, mix, prefix, spans_hash, split

#: Words of a window, and from one window's start to the next.
WINDOW, STRIDE = 64, 48
WORD_ROWS, WORD_SIZE, GRAM_ROWS, GRAM_SIZE = 1 << 14, 8, 1 << 16, 16
HIDDEN, ATTENTION = 8, 8
GRAMS = (3, 4, 5)
#: Windows that are scored at once.
_BATCH = 4096


@dataclass
class Words:
    """Texts as words: distinct words with their inputs, and the distinct word of each place."""

    word_row: np.ndarray  # embedding row by distinct word
    gram_row: np.ndarray  # embedding rows of n-grams, word after word
    gram_start: np.ndarray  # first n-gram by distinct word (one longer)
    places: np.ndarray  # distinct word by place
    counts: np.ndarray  # words before each text (one longer)


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends, counts = split(data, offsets, ALNUM)
    sums = prefix(_BYTE[_LOWER[data[int(offsets[0]) : int(offsets[-1])]]])
    hashes = spans_hash(sums, starts, ends)
    distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
    start, size = starts[first], (ends - starts)[first]
    # n-grams of each distinct word; a word shorter than every n is its own n-gram
    owners, rows = [], []
    for n in GRAMS:
        many = np.maximum(size - n + 1, 0)
        if n == GRAMS[0]:
            many = np.maximum(many, 1)
        owner = np.repeat(np.arange(len(distinct)), many)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        at = start[owner] + inside
        h = spans_hash(sums, at, np.minimum(at + n, start[owner] + size[owner]))
        h[inside == 0] = mix(h[inside == 0] + np.uint64(1))
        owners.append(owner)
        rows.append((h % np.uint64(GRAM_ROWS)).astype(np.int32))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    gram_start = np.append(0, np.cumsum(np.bincount(owner, minlength=len(distinct))))
    return Words((distinct % np.uint64(WORD_ROWS)).astype(np.int32), np.concatenate(rows)[order], gram_start, places, counts)


def join_words(parts: list[Words]) -> Words:
    """Blocks of texts as one; a word of several blocks is distinct in each."""
    distinct = np.cumsum([0] + [len(p.word_row) for p in parts])
    rows = np.cumsum([0] + [len(p.gram_row) for p in parts])
    places = np.cumsum([0] + [len(p.places) for p in parts])
    return Words(
        np.concatenate([p.word_row for p in parts]), np.concatenate([p.gram_row for p in parts]),
        np.concatenate([p.gram_start[:-1] + r for p, r in zip(parts, rows, strict=False)] + [rows[-1:]]),
        np.concatenate([(p.places + d).astype(np.int32) for p, d in zip(parts, distinct, strict=False)]),
        np.concatenate([p.counts[:-1] + n for p, n in zip(parts, places, strict=False)] + [places[-1:]]),
    )


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, words and text of all windows: every ``STRIDE`` words until one reaches the text's end."""
    n = np.diff(counts)
    many = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(n)), many)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    first = counts[:-1][text] + inside * STRIDE
    return first, np.minimum(WINDOW, counts[1:][text] - first), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sum_rows(values: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indexes and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    begin = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    return index[begin], np.add.reduceat(values[order], begin, axis=0)


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        inputs = WORD_SIZE + GRAM_SIZE
        self.words, self.grams = f(WORD_ROWS, WORD_SIZE, s=0.1), f(GRAM_ROWS, GRAM_SIZE, s=0.1)
        self.dense = {
            "x": f(2, inputs, 3 * HIDDEN, s=inputs**-0.5), "u": f(2, HIDDEN, 3 * HIDDEN, s=HIDDEN**-0.5), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "a": f(2 * HIDDEN, ATTENTION, s=0.3), "v": f(ATTENTION, s=0.3), "o": f(2 * HIDDEN, s=0.3), "c": np.full(1, -2, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, w: Words, distinct: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs of (some) distinct words; the n-gram rows read and how many each word has."""
        if distinct is None:
            rows, many = w.gram_row, np.diff(w.gram_start)
            word_row = w.word_row
        else:
            many = np.diff(w.gram_start)[distinct]
            begin = np.cumsum(many) - many
            rows = w.gram_row[np.repeat(w.gram_start[distinct] - begin, many) + np.arange(many.sum())]
            word_row = w.word_row[distinct]
        out = np.empty((len(many), WORD_SIZE + GRAM_SIZE), np.float32)
        out[:, :WORD_SIZE] = self.words[word_row]
        # a block of words at a time, so that the n-gram vectors stay few
        end = np.cumsum(many)
        for a in range(0, len(many), 1 << 14):
            b = min(a + (1 << 14), len(many))
            lo = end[a] - many[a]
            out[a:b, WORD_SIZE:] = np.add.reduceat(self.grams[rows[lo : end[b - 1]]], (end - many)[a:b] - lo, axis=0) / many[a:b, None]
        return out, rows, many

    def forward(self, gates: np.ndarray, places: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows: ``gates`` (2, distinct, 3h) by distinct word, ``places`` (T, B) of distinct words, ``size`` (B)."""
        p, t_all, b = self.dense, *places.shape
        h = np.zeros((2, b, HIDDEN), np.float32)
        states = np.empty((t_all, 2, b, HIDDEN), np.float32)
        masks = (np.arange(t_all)[:, None] < size).astype(np.float32)
        kept = []
        for t in range(t_all):
            back = t_all - 1 - t
            x = np.stack([gates[0][places[t]], gates[1][places[back]]])
            m = np.stack([masks[t], masks[back]])[:, :, None]
            g = h @ p["u"]
            zr = 1 / (1 + np.exp(-(x[..., : 2 * HIDDEN] + g[..., : 2 * HIDDEN])))
            z, r, hu = zr[..., :HIDDEN], zr[..., HIDDEN:], g[..., 2 * HIDDEN :]
            n = np.tanh(x[..., 2 * HIDDEN :] + r * hu)
            new = h + m * (1 - z) * (n - h)
            if keep:
                kept.append((h, z, r, n, hu, m))
            states[t] = h = new
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        e = np.tanh(both @ p["a"])
        score = e @ p["v"]
        score = np.where(masks > 0, score, -1e9)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", weight, both)
        logit = pooled @ p["o"] + p["c"][0]
        return (logit, (both, e, weight, pooled, kept)) if keep else logit

    def gradients(self, d: np.ndarray, places: np.ndarray, state: tuple) -> tuple[dict, np.ndarray]:
        """Of the dense weights, and of the gates by place (T, 2, B, 3h), from those of the logits."""
        both, e, weight, pooled, kept = state
        p, t_all = self.dense, len(places)
        g = {"o": pooled.T @ d, "c": d.sum(keepdims=True)}
        dpooled = d[:, None] * p["o"]
        dweight = np.einsum("bh,tbh->tb", dpooled, both)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        de = dscore[..., None] * p["v"] * (1 - e * e)
        g["v"] = np.einsum("tb,tba->a", dscore, e)
        g["a"] = np.einsum("tbh,tba->ha", both, de)
        dboth = weight[..., None] * dpooled + de @ p["a"].T
        dgates = np.empty((t_all, 2, places.shape[1], 3 * HIDDEN), np.float32)
        g["u"] = np.zeros_like(p["u"])
        carry = np.zeros((2, places.shape[1], HIDDEN), np.float32)
        for t in range(t_all - 1, -1, -1):
            h, z, r, n, hu, m = kept[t]
            carry = carry + np.stack([dboth[t, :, :HIDDEN], dboth[t_all - 1 - t, :, HIDDEN:]])
            dnew = m * carry
            dn = dnew * (1 - z) * (1 - n * n)
            dz = dnew * (h - n) * z * (1 - z)
            dr = dn * hu * r * (1 - r)
            dgates[t] = np.concatenate([dz, dr, dn], axis=2)
            du = np.concatenate([dz, dr, dn * r], axis=2)
            g["u"] += h.transpose(0, 2, 1) @ du
            carry = carry - dnew + dnew * z + du @ p["u"].transpose(0, 2, 1)
        return g, dgates

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Logit of the most toxic window of each text; minus infinity without a window."""
        w = read_words(data, offsets)
        out = np.full(len(offsets) - 1, -np.inf)
        first, size, text = windows(w.counts)
        if not len(first):
            return out
        x, _, _ = self.inputs(w)
        gates = x @ self.dense["x"] + self.dense["b"]
        order = np.argsort(size, kind="stable")
        for a in range(0, len(order), _BATCH):
            some = order[a : a + _BATCH]
            longest = int(size[some].max())
            at = np.minimum(first[some] + np.arange(longest)[:, None], len(w.places) - 1)
            np.maximum.at(out, text[some], self.forward(gates, w.places[at], size[some]))
        return out

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return np.where(np.isfinite(logit), _sigmoid(self.scale * np.where(np.isfinite(logit), logit, 0) + self.shift), 0.0)


def train(texts: list[str], labels: np.ndarray, epochs: int = 5, steps: int = 160, seed: int = 7, odds: float = 1.0) -> Network:
    """A network from texts and their labels, in ``epochs`` passes and ``steps``
    batches at least; every fifth text is held back for the two constants.
    ``odds``: how much likelier a toxic row was drawn than a clean one."""
    rng = np.random.default_rng(seed)
    data, offsets = utf8(pa.array(texts, pa.string()))
    held = np.arange(len(texts)) % 5 == 4
    w = join_words([read_words(data, offsets[a : b + 1]) for a, b in blocks(offsets)])
    first, size, text = windows(w.counts)
    net = Network(seed)
    edge = np.searchsorted(text, np.arange(len(texts) + 1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.dense.items()}
    squares = {"words": np.full((WORD_ROWS, 1), 1e-8, np.float32), "grams": np.full((GRAM_ROWS, 1), 1e-8, np.float32)}
    step = epoch = 0
    batch = min(max(len(first) // 40, 64), 768)
    while epoch < epochs or 0 < step < steps:
        epoch += 1
        bags = []
        for i in rng.permutation(np.flatnonzero(~held & (edge[1:] > edge[:-1]))):
            own = np.arange(edge[i], edge[i + 1])
            # of a clean text a few windows an epoch, others each time; of a toxic one all, as one bag
            bags.append(own if labels[i] else rng.permutation(own)[:8])
        at = 0
        while at < len(bags):
            upto, n = at, 0
            while upto < len(bags) and (n == 0 or n + len(bags[upto]) <= batch):
                n += len(bags[upto])
                upto += 1
            some, at = np.concatenate(bags[at:upto]), upto
            step += 1
            _train_batch(net, w, first[some], size[some], text[some], labels, moments, squares, step)
    logit = np.concatenate([net.scores(data, offsets[a : b + 1]) for a, b in blocks(offsets)])
    use = held & np.isfinite(logit)
    if len(np.unique(labels[use])) == 2:
        net.scale, net.shift = _platt(logit[use], labels[use])
    net.shift -= float(np.log(odds))
    return net


def _train_batch(net, w, first, size, text, labels, moments, squares, step) -> None:
    longest = int(size.max())
    places = w.places[np.minimum(first + np.arange(longest)[:, None], len(w.places) - 1)]
    distinct, index = np.unique(places, return_inverse=True)
    index = index.reshape(places.shape)
    x, rows, many = net.inputs(w, distinct)
    gates = x @ net.dense["x"] + net.dense["b"]
    logit, state = net.forward(gates, index, size, keep=True)
    p = _sigmoid(logit)
    toxic = labels[text] == 1
    # bag of a toxic text: P = 1 - prod(1 - p); d(-log P)/dlogit = -p (1 - P) / P
    owner, which = np.unique(text, return_inverse=True)
    clean = np.bincount(which, np.log1p(-np.minimum(p, 1 - 1e-7)), len(owner))
    bag = np.maximum(-np.expm1(clean), 1e-7)
    d = np.where(toxic, -p * ((1 - bag) / bag)[which], p).astype(np.float32)
    d /= len(owner)
    g, dgates = net.gradients(d, index, state)
    size_g = 3 * HIDDEN
    back = index[::-1]
    by_word = []
    for k, idx in enumerate((index, back)):
        found, sums = _sum_rows(dgates[:, k].reshape(-1, size_g), idx.reshape(-1))
        full = np.zeros((len(distinct), size_g), np.float32)
        full[found] = sums
        by_word.append(full)
    dgate = np.stack(by_word)
    g["x"] = x.T @ dgate
    g["b"] = dgate.sum(axis=1, keepdims=True)
    dx = (dgate @ net.dense["x"].transpose(0, 2, 1)).sum(axis=0)
    norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
    clip = min(1.0, 1.0 / (norm + 1e-9))
    for k, v in g.items():
        m, s = moments[k]
        m *= 0.9
        m += 0.1 * clip * v
        s *= 0.999
        s += 0.001 * (clip * v) ** 2
        net.dense[k] = (net.dense[k] - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    dgram = np.repeat(dx[:, WORD_SIZE:] / many[:, None], many, axis=0)
    for table, values, row in (("words", dx[:, :WORD_SIZE], w.word_row[distinct]), ("grams", dgram, rows)):
        found, sums = _sum_rows(values, row)
        squares[table][found] += (sums * sums).mean(axis=1, keepdims=True)
        getattr(net, table)[found] -= 0.05 * sums / np.sqrt(squares[table][found])


def _platt(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logit by logistic regression (Newton), a little shrunk."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * logit + b)
        r, v = labels - p, p * (1 - p) + 1e-6
        grad = np.array([(r * logit).sum() - 0.1 * (a - 1), r.sum() - 0.1 * b])
        hess = np.array([[(v * logit * logit).sum() + 0.1, (v * logit).sum()], [(v * logit).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(hess, grad)
        a, b = a + float(np.clip(step[0], -0.5, 0.5)), b + float(np.clip(step[1], -2, 2))
    return max(a, 0.05), b


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label") -> Network | None:
    """The network of the texts that ``labels`` (id, 0 or 1) names; None when one of the labels has no row with text.

    The sample is drawn from the labels, so that only its rows are read from the texts."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    n = {r.label: r.n for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    steps = {label: n[label] // sample_rows + 1 for label in (0, 1)}
    step = F.when(F.col("label") == 1, steps[1]).otherwise(steps[0])
    drawn = own.where(F.pmod(F.xxhash64("id"), step) == 0).distinct().toArrow()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("length(text) > 0")
    rows = texts.join(docs.sparkSession.createDataFrame(drawn), "id").select("text", "label").collect()
    rows = sorted((r.text, r.label) for r in rows)
    rows = [rows[i] for i in np.random.default_rng(3).permutation(len(rows))]
    y = np.array([label for _, label in rows])
    return train([text for text, _ in rows], y, odds=steps[0] / steps[1]) if len(np.unique(y)) == 2 else None


def score(docs: DataFrame, net: Network | None, text_col: str = "text", threshold: float = 0.3, row: Column | None = None) -> DataFrame:
    """The rows of ``docs`` (``row``: what to keep of each, all columns if not given) as ``row``, with score and predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    own = docs.select((F.struct("*") if row is None else row).alias("row"), F.col(text_col).alias("text"))
    out = own.mapInArrow(partial(_score, sent), f"row {own.schema['row'].dataType.simpleString()}, score double")
    return out.select("row", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _score(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    net: Network | None = sent.value
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for first, last in blocks(offsets):
            p = net.probability(net.scores(data, offsets[first : last + 1])) if net else np.zeros(last - first)
            yield pa.RecordBatch.from_arrays([batch.column("row").slice(first, last - first), pa.array(p)], ["row", "score"])
