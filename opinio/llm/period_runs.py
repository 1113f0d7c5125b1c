"""Periodic run detection (12) by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, at least ``copies``
times q and ``least`` words long, that no neighbouring word extends keeping q.

The words of a block of texts are one array of symbols, each text's symbols its
own, so nothing matches across texts.  Prefix doubling names the factors of 1, 2,
4, .. words and sorts the suffixes; a factor's occurrences are an interval of the
suffix array.  The dyadic blocks (the factors of 2^k words at multiples of 2^k) ask
for their occurrences that start in the neighbouring window [2^k, 2^(k+1)) behind
them: range successors in a wavelet tree over the suffix array.  A run of period q
in that window, four times as long as q, contains a block that occurs again q words
on.  One or two occurrences are candidate periods themselves; three or more are an
arithmetic progression, and the distance between the ends of the two stretches that
keep its difference is the candidate.  Longest common extensions by the factors'
names give a candidate's whole stretch.  A stretch found with several periods is a
run of the least.

Defined cases: null counts as the empty text; no words, no runs.  Words are runs of
anything but white space, compared by 64-bit hashes.  A very long text is a block of
its own in its task (arrays of some 100 bytes a word).  Repeated rows and repeated
or null ids each keep their row; an empty table gives an empty one; only the id, the
text and ``keep`` are read, other columns' names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import blocks, utf8
from opinio.llm.words import NOT_SPACE, hashed

#: Least length of a run in words, and in periods.  The search needs four periods.
LEAST, COPIES = 6, 4
_ONE = np.uint64(1)
_LOW = np.uint64(63)


class Bits:
    """A bit array with the number of set bits before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (_ONE << (at.astype(np.uint64) & _LOW)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """A wavelet tree, level by level, over a permutation; queries are arrays."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.height = max(int(self.size - 1).bit_length(), 1)
        self.levels: list[tuple[Bits, int]] = []
        for shift in range(self.height - 1, -1, -1):
            high = (values >> shift & 1).astype(bool)
            self.levels.append((Bits(high), int(self.size - high.sum())))
            values = np.concatenate([values[~high], values[high]])

    def below(self, first: np.ndarray, last: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of the values at [first, last) are less than ``limit``."""
        count = np.where(limit >= self.size, last - first, 0)
        limit = np.where(limit >= self.size, 0, limit)
        for level, (bits, zeros) in enumerate(self.levels):
            a, b = bits.ones(first), bits.ones(last)
            high = limit >> (self.height - 1 - level) & 1 == 1
            count += np.where(high, (last - first) - (b - a), 0)
            first, last = np.where(high, zeros + a, first - a), np.where(high, zeros + b, last - b)
        return count

    def smallest(self, first: np.ndarray, last: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values at [first, last)."""
        value = np.zeros(len(first), np.int64)
        for bits, zeros in self.levels:
            a, b = bits.ones(first), bits.ones(last)
            low = (last - first) - (b - a)
            high = k >= low
            value = value << 1 | high
            k = np.where(high, k - low, k)
            first, last = np.where(high, zeros + a, first - a), np.where(high, zeros + b, last - b)
        return value

    def successor(self, first: np.ndarray, last: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest of the values at [first, last) that is at least ``least``; the array's size if none."""
        k = self.below(first, last, least)
        out = np.full(len(first), self.size)
        some = np.flatnonzero(k < last - first)
        out[some] = self.smallest(first[some], last[some], k[some])
        return out


class Factors:
    """Names of the factors of 1, 2, 4, .. symbols by place, and the suffix array by the longest of them."""

    def __init__(self, symbols: np.ndarray, longest: int):
        n = len(symbols)
        self.size = n
        _, name = np.unique(symbols, return_inverse=True)
        self.names = [name]
        order = np.argsort(name, kind="stable")
        while 2 << (len(self.names) - 1) <= longest and int(name.max()) < n - 1:
            step = 1 << (len(self.names) - 1)
            then = np.zeros(n, np.int64)
            then[: n - step] = name[step:] + 1
            key = name * (n + 1) + then
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            name = np.empty(n, np.int64)
            name[order] = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
            self.names.append(name)
        self.order = order

    def intervals(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array intervals of the factors of 2^k symbols at these places."""
        count = np.bincount(self.names[k])
        last = np.cumsum(count)[self.names[k][at]]
        return last - count[self.names[k][at]], last

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from a on equal those from b on (a < b)."""
        return self._extend(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before a equal those before b (a < b)."""
        return self._extend(a, b, -1)

    def _extend(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, step = self.names[k], 1 << k
            live = np.arange(len(a))
            while len(live):
                # the factor's first place, ahead or behind; one that does not fit matches nothing
                x, y = a[live] + way * total[live], b[live] + way * total[live]
                if way < 0:
                    x, y = x - step, y - step
                fits = (x >= 0) & (y + step <= self.size)
                live, x, y = live[fits], x[fits], y[fits]
                live = live[name[x] == name[y]]
                total[live] += step
        return total


def find_runs(symbols: np.ndarray, longest: int, least: int = LEAST, copies: int = COPIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start, then period.  Symbols of different texts differ;
    ``longest`` is the length of the longest text."""
    if copies < 4:
        raise ValueError("the search by blocks needs runs of four periods")
    none = np.zeros(0, np.int64)
    if longest < least:
        return none, none, none
    factors = Factors(symbols, max(longest // copies, 1))
    n, tree = factors.size, Wavelet(factors.order)
    places, periods = [], []
    for k in range(len(factors.names)):
        step = 1 << k
        at = np.arange(0, n, step)
        first, last = factors.intervals(k, at)
        some = np.flatnonzero(last - first > 1)
        at, first, last = at[some], first[some], last[some]
        found, until = [], at + 2 * step
        for _ in range(3):  # occurrences in the window: the first, the second, a third
            least_start = found[-1] + 1 if found else at + step
            found.append(tree.successor(first, last, least_start))
            some = np.flatnonzero(found[-1] < until)
            if len(found) == 3:
                break
            places.append(at[some])
            periods.append(found[-1][some] - at[some])
            at, first, last, until = at[some], first[some], last[some], until[some]
            found = [x[some] for x in found]
        # a progression: where do the stretches that keep its difference end?
        at, one, two = at[some], found[0][some], found[1][some]
        gap = two - one
        q = (two + factors.forward(one, two)) - (at + gap + factors.forward(at, at + gap))
        fits = (q >= step) & (q < 2 * step)
        places.append(at[fits])
        periods.append(q[fits])
    place, period = np.concatenate(places), np.concatenate(periods)
    start = place - factors.backward(place, place + period)
    length = place + period + factors.forward(place, place + period) - start
    fits = (length >= least) & (length >= copies * period)
    start, length, period = start[fits], length[fits], period[fits]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _runs(least: int, copies: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in blocks(offsets, 1 << 18):
            h, starts, ends, counts = hashed(data, offsets[a : b + 1], NOT_SPACE, False)
            sizes = np.diff(counts)
            text = np.repeat(np.arange(b - a), sizes)
            # a symbol for each word of each text
            order = np.lexsort((h, text))
            new = np.append(False, (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1]))[: len(h)]
            symbols = np.empty(len(h), np.int64)
            symbols[order] = np.cumsum(new)
            start, length, period = find_runs(symbols, int(sizes.max(initial=0)), least, copies)
            gone = np.zeros(len(h) + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, start + length, -1)
            kept = np.cumsum(gone[:-1]) == 0
            of = text[start] if len(start) else start
            first = np.searchsorted(of, np.arange(b - a + 1))
            part, words = data[int(offsets[a]) : int(offsets[b])], np.flatnonzero(kept)
            limits = np.searchsorted(words, counts)
            collapsed, best = [], []
            for i in range(b - a):
                w = words[limits[i] : limits[i + 1]]
                collapsed.append(_join(part, starts[w], ends[w]))
                found = zip(*(x[first[i] : first[i + 1]].tolist() for x in (start, length, period)), strict=True)
                top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                best.append(top and {"start": top[0] - int(counts[i]), "length": top[1], "period": top[2]})
            runs = pa.StructArray.from_arrays([pa.array(start - counts[of]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(a, b - a), pa.array(sizes), lists, pa.array(best, runs.type), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["row", "n_words", "runs", "best", "collapsed"],
            )


def _join(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words joined by one space."""
    if not len(starts):
        return b""
    sizes = ends - starts + 1
    at = np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes) + np.repeat(starts, sizes)
    out = data[np.minimum(at, len(data) - 1)]
    out[sizes.cumsum() - 1] = 32
    return out[:-1].tobytes()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = (), least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """One row per row of ``docs``: ``row`` (the id and ``keep``), n_words, ``runs`` (start, length, period; by start,
    then period; word numbers from 0), ``best`` (the run of most periods; ties: least start, then period) and
    ``collapsed``, the words joined by one space without those that a run contains after its first period."""
    own = docs.select(F.struct(docs[id_col].alias(id_col), *keep).alias("row"), docs[text_col].alias("text"))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return own.mapInArrow(partial(_runs, least, copies), f"row {own.schema['row'].dataType.simpleString()}, n_words bigint, runs array<{run}>, best {run}, collapsed string")
