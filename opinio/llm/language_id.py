"""Language ID (8): interpolated Kneser-Ney character models per language in
sorted hash arrays; the lowest length-normalised cross-entropy wins, with
calibrated rejection.

Text is lower-cased, every run of other characters than letters becomes one
space.  Each language's model is fitted from a bounded sample of its different
texts (``sample_texts``: all if there are not more, else between half and all of
so many expected, taken by a hash of the text; copies count once), so that every
labelled language has a model.  One task counts one language's grams; the driver
joins the arrays and broadcasts them: for every order the sorted hashes of all
n-grams seen in some language, with their log-probability under each language
that has them, and the sorted hashes of the contexts with their back-off weights
(so the arrays grow with the grams of the samples, not with these times the
languages).  What a language lacks follows from its shorter grams when a block of
texts is scored, once for each different gram of the block.  Scoring is a narrow
pass over whole texts.

A quarter of each sample is held back to calibrate, in tasks: the factor by which
differences of cross-entropy become a confidence, and each language's greatest
accepted cross-entropy.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and rejected; so is every text when no row is labelled.  Null languages teach
nothing.  A very long text is scored on its own.  Equal cross-entropies go to the
language that sorts first.  Repeated rows stay; other columns are not read.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import blocks, utf8

ORDER = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Positions scored at once.
_CHUNK = 1 << 18
#: Factors tried when differences of cross-entropy are made a confidence.
_SHARPNESS = (0.25, 0.5, 1, 2, 4, 8, 16, 32)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the normalised texts, ``ORDER - 1`` spaces before each; which of them are scored; the text of each."""
    low = [(t or "").lower() for t in texts]
    size = np.array([len(t) for t in low], np.int64)
    codes = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    text = np.repeat(np.arange(len(low)), size)
    letter = _letters()[codes]
    first = np.zeros(len(codes), bool)
    first[np.cumsum(size)[:-1][size[1:] > 0]] = True
    follows = np.append(False, letter[:-1]) & ~first
    kept = letter | follows
    text, codes = text[kept], np.where(letter, codes, 32)[kept]
    out = np.full(len(codes) + len(low) * (ORDER - 1), 32, np.uint64)
    place = np.arange(len(codes)) + (text + 1) * (ORDER - 1)
    out[place] = codes
    scored = np.zeros(len(out), bool)
    scored[place] = True
    owner = np.zeros(len(out), np.int64)
    owner[place] = text
    return out, scored, owner


def gram_hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each position (too few: of those there are)."""
    h = np.zeros(len(codes), np.uint64)
    for back in range(order - 1, -1, -1):
        h *= _STEP
        h[back:] += codes[: len(codes) - back] + np.uint64(1)
    return h


@dataclass
class Counts:
    """A language's grams of one order: hash, hash without the first and without the last character, count."""

    gram: np.ndarray
    suffix: np.ndarray
    context: np.ndarray
    count: np.ndarray


def count_grams(texts: list[str]) -> list[Counts]:
    """Grams of orders 1 .. ORDER; below the highest order a gram counts its distinct preceding characters."""
    codes, scored, _ = characters(texts)
    position = np.flatnonzero(scored)
    found = []
    for order in range(ORDER, 0, -1):
        gram, at, n = np.unique(gram_hashes(codes, order)[position], return_index=True, return_counts=True)
        at = position[at]
        suffix = gram_hashes(codes, order - 1)[at] if order > 1 else np.zeros(len(at), np.uint64)
        context = gram_hashes(codes, order - 1)[at - 1] if order > 1 else np.zeros(len(at), np.uint64)
        if found:
            above, kinds = np.unique(found[-1].suffix, return_counts=True)
            n = np.zeros(len(gram), np.int64)
            n[np.searchsorted(gram, above)] = kinds
        found.append(Counts(gram, suffix, context, n))
    return found[::-1]


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


def _distinct(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, of indexes below ``size``, and where each index stands among them."""
    if len(index) * 16 < size:
        return np.unique(index, return_inverse=True)
    there = np.zeros(size, bool)
    there[index] = True
    found = np.flatnonzero(there)
    place = np.empty(size, np.int64)
    place[found] = np.arange(len(found))
    return found, place[index]


@dataclass
class Sparse:
    """Sorted hashes, each with the languages that have it and a value for each of these."""

    hashes: np.ndarray
    first: np.ndarray
    language: np.ndarray
    value: np.ndarray

    @classmethod
    def joined(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        """Of each language's hashes and values, in the languages' order."""
        hashes = np.concatenate([h for h, _ in parts])
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
        language = np.repeat(np.arange(len(parts), dtype=np.int32), [len(h) for h, _ in parts])
        return cls(hashes[first], np.append(first, len(hashes)), language[order], np.concatenate([v for _, v in parts]).astype(np.float32)[order])

    def put(self, rows: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Puts the values of the hashes at ``index`` into rows by language."""
        many = self.first[index + 1] - self.first[index]
        row = np.repeat(np.arange(len(index)), many)
        at = np.arange(len(row)) + np.repeat(self.first[index] - np.cumsum(many) + many, many)
        rows[row, self.language[at]] = self.value[at]
        return rows


@dataclass
class Level:
    """One order: log-probabilities of grams, with the place of each gram's suffix (among the grams of the order
    below) and of its context; log back-off weights of contexts."""

    grams: Sparse
    suffix: np.ndarray
    context: np.ndarray
    contexts: Sparse


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]
    unseen: float  # log-probability of a character that no text had
    sharpness: float = 1.0
    accepted: np.ndarray | None = None

    def weights(self, order: int, context: np.ndarray) -> np.ndarray:
        """Log back-off weights by language of contexts, by their places; 0 where a language lacks the context."""
        contexts = self.levels[order - 1].contexts
        found, place = _distinct(context, len(contexts.hashes))
        return contexts.put(np.zeros((len(found), len(self.languages)), np.float32), found)[place]

    def rows(self, order: int, gram: np.ndarray) -> np.ndarray:
        """Log-probabilities by language of grams, by their places."""
        if order == 0:
            return np.full((len(gram), len(self.languages)), self.unseen, np.float32)
        level = self.levels[order - 1]
        size = len(self.levels[order - 2].grams.hashes) if order > 1 else 1
        found, place = _distinct(level.suffix[gram], size)
        return level.grams.put(self.rows(order - 1, found)[place] + self.weights(order, level.context[gram]), gram)

    def positions(self, hashes: list[np.ndarray], at: np.ndarray, order: int) -> np.ndarray:
        """Log-probabilities by language of the characters at ``at`` after ``order - 1`` others."""
        if order == 0:
            return self.rows(0, at)
        level = self.levels[order - 1]
        where, seen = _find(level.grams.hashes, hashes[order][at])
        out = np.empty((len(at), len(self.languages)), np.float32)
        if seen.any():
            found, place = _distinct(where[seen], len(level.grams.hashes))
            out[seen] = self.rows(order, found)[place]
        miss = np.flatnonzero(~seen)
        if len(miss):
            lower = self.positions(hashes, at[miss], order - 1)
            context, known = _find(level.contexts.hashes, hashes[order - 1][at[miss] - 1] if order > 1 else np.zeros(len(miss), np.uint64))
            if known.any():
                lower[known] += self.weights(order, context[known])
            out[miss] = lower
        return out

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats a character by text and language, and the characters scored."""
        codes, scored, owner = characters(texts)
        hashes = [np.zeros(len(codes), np.uint64), *[gram_hashes(codes, k) for k in range(1, ORDER + 1)]]
        total = np.zeros((len(texts), len(self.languages)))
        every = np.flatnonzero(scored)
        chunk = max(_CHUNK // (len(self.languages) // 16 + 1), 1)
        for first in range(0, len(every), chunk):
            at = every[first : first + chunk]
            logp, text = self.positions(hashes, at, ORDER), owner[at]
            begin = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            total[text[begin]] += np.add.reduceat(logp, begin, axis=0, dtype=np.float64)
        n = np.bincount(owner[every], minlength=len(texts))
        return -total / np.maximum(n, 1)[:, None], n


def _kneser_ney(counts: list[Counts], unseen: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A language's orders: hashes and log-probabilities of its grams, hashes and log back-off weights of its contexts."""
    below, logp = None, None
    for c in counts:
        lower = np.full(len(c.gram), unseen) if below is None else logp[np.searchsorted(below, c.suffix)]
        once, twice = (c.count == 1).sum(), (c.count == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts, there = np.unique(c.context, return_inverse=True)
        total = np.bincount(there, c.count, len(contexts))
        weight = discount * np.bincount(there, minlength=len(contexts)) / total
        below, logp = c.gram, np.log((c.count - discount) / total[there] + weight[there] * np.exp(lower))
        yield c.gram, logp, contexts, np.log(weight)


def join_models(counts: dict[str, list[Counts]]) -> Model:
    """Interpolated Kneser-Ney models of all languages in arrays by hash: a value for each gram a language has, none for others."""
    languages = sorted(counts)
    unseen = -float(np.log(len(np.unique(np.concatenate([counts[x][0].gram for x in languages]))) + 1))
    fitted = [list(_kneser_ney(counts[x], unseen)) for x in languages]
    levels: list[Level] = []
    for k in range(ORDER):
        grams = Sparse.joined([f[k][:2] for f in fitted])
        contexts = Sparse.joined([f[k][2:] for f in fitted])
        suffix, context = np.zeros(len(grams.hashes), np.int32), np.zeros(len(grams.hashes), np.int32)
        for x in languages:
            c = counts[x][k]
            at = np.searchsorted(grams.hashes, c.gram)
            context[at] = np.searchsorted(contexts.hashes, c.context)
            if levels:
                suffix[at] = np.searchsorted(levels[-1].grams.hashes, c.suffix)
        levels.append(Level(grams, suffix, context, contexts))
    return Model(languages, levels, unseen)


def _fit_language(rows: pd.DataFrame) -> pd.DataFrame:
    texts = sorted(rows["text"])
    held = texts[::4] if len(texts) > 4 else texts
    taught = [t for i, t in enumerate(texts) if i % 4] if len(texts) > 4 else texts
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "counts": [pickle.dumps(count_grams(taught))], "held": [held]})


def fit(docs: DataFrame, learn: Column, sample_texts: int = 300, lang_col: str = "lang", text_col: str = "text") -> Model | None:
    """The model of the rows for which ``learn`` holds; None when none has a language and a letter."""
    own = docs.where(learn).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    own = own.where(r"lang is not null and text rlike '\\p{L}'").withColumn("t", F.xxhash64("text"))
    # different texts of each language, by narrow rows that are combined before the shuffle
    size = own.select("lang", "t").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not size:
        return None
    steps = docs.sparkSession.createDataFrame([(r.lang, (r.n - 1) // sample_texts + 1) for r in size], "lang string, step bigint")
    # the sample is drawn where the rows are read, one row for each language is broadcast; a text's copies are combined before they move
    sample = own.join(F.broadcast(steps), "lang").where(F.pmod("t", "step") == 0).groupBy("lang", "t").agg(F.min("text").alias("text")).select("lang", "text")
    fitted = sample.groupBy("lang").applyInPandas(_fit_language, "lang string, counts binary, held array<string>").persist(StorageLevel.DISK_ONLY)
    counts = {r.lang: pickle.loads(r.counts) for r in fitted.select("lang", "counts").collect()}
    if not counts:
        return None
    model = join_models(counts)
    # the held-back texts are scored where they are; a few numbers of each come back
    sent = docs.sparkSession.sparkContext.broadcast(model)
    held = fitted.select("lang", F.explode("held").alias("text")).mapInArrow(partial(_held_back, sent), "lang string, entropy double, losses array<double>").toArrow()
    fitted.unpersist()
    lang, entropy = np.array(held.column("lang").to_pylist()), held.column("entropy").to_numpy()
    model.sharpness = _SHARPNESS[int(np.mean(held.column("losses").to_pylist(), axis=0).argmin())]
    model.accepted = np.array([1.25 * np.quantile(entropy[lang == x], 0.99) for x in model.languages])
    return model


def _held_back(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text: its language, the cross-entropy under it, and the language's negative log-confidence at each sharpness."""
    model: Model = sent.value
    for batch in batches:
        for first, last in blocks(utf8(batch.column("text"))[1], 1 << 18):
            lang = batch.column("lang").slice(first, last - first)
            entropy, _ = model.cross_entropy(batch.column("text").slice(first, last - first).to_pylist())
            own = entropy[np.arange(len(entropy)), np.searchsorted(model.languages, lang.to_pylist())]
            least = entropy.min(axis=1, keepdims=True)
            losses = [x * (own - least[:, 0]) + np.log(np.exp(-x * (entropy - least)).sum(axis=1)) for x in _SHARPNESS]
            yield pa.RecordBatch.from_arrays([lang, pa.array(own), pa.array(np.stack(losses, axis=1).tolist(), pa.list_(pa.float64()))], ["lang", "entropy", "losses"])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score, cross_entropy and accepted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, lang_pred string, score double, cross_entropy double, accepted boolean"
    return own.mapInArrow(partial(_identify, sent), schema).withColumnRenamed("id", id_col)


def _identify(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model: Model | None = sent.value
    for batch in batches:
        for first, last in blocks(utf8(batch.column("text"))[1], 1 << 18):
            texts = batch.column("text").slice(first, last - first).to_pylist()
            best, score, entropy, good = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
            if model is not None:
                by_language, n = model.cross_entropy(texts)
                letters = np.flatnonzero(n)
                k = by_language.argmin(axis=1)
                z = np.exp(-model.sharpness * (by_language - by_language.min(axis=1, keepdims=True)))
                score[letters] = 1 / z.sum(axis=1)[letters]
                entropy[letters] = by_language.min(axis=1)[letters]
                good[letters] = (by_language.min(axis=1) <= model.accepted[k])[letters]
                for i in letters.tolist():
                    best[i] = model.languages[k[i]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(first, last - first), pa.array(best, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(good)],
                ["id", "lang_pred", "score", "cross_entropy", "accepted"],
            )
