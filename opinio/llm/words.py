"""Words of texts as 64-bit hashes, computed on the bytes of whole blocks of
texts at once.

A word's hash is its polynomial over the bytes (from prefix sums modulo 2^64,
normalised to its start) put through a mixing function, so that it depends on
the word alone and is equal in every task.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 .. n-1 modulo 2^64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 16) - 1, base, np.uint64)]).cumprod(dtype=np.uint64)
        if n <= 1 << 21:
            _POWERS[int(base)] = have
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i``; one longer than ``values``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of what ``prefix`` summed."""
    raw = (sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def byte_class(separators: bytes) -> np.ndarray:
    """True for bytes that belong to words; bytes of multi-byte characters always do."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


#: Words are runs of anything but white space (space, tab to carriage return).
NOT_SPACE = byte_class(b" \t\n\x0b\x0c\r")
#: Words are runs of ASCII letters, digits and non-ASCII characters.
ALNUM = byte_class(bytes(b for b in range(128) if not chr(b).isalnum()))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def split(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of the texts ``data[offsets[i]:offsets[i+1]]``
    (relative to ``offsets[0]``) and the number of words before each text (one longer than the texts)."""
    base = int(offsets[0])
    end = int(offsets[-1])
    word = inside[data[base:end]]
    cut = np.zeros(len(word) + 1, bool)
    cut[offsets - base] = True
    after = np.zeros(len(word) + 1, bool)
    after[1:] = word
    now = np.zeros(len(word) + 1, bool)
    now[:-1] = word
    starts = np.flatnonzero(now & (~after | cut))
    ends = np.flatnonzero(after & (~now | cut))
    return starts, ends, np.searchsorted(starts, offsets - base)


def hashed(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``split`` with the hash of each word; ``lower`` folds A-Z first."""
    starts, ends, counts = split(data, offsets, inside)
    part = data[int(offsets[0]) : int(offsets[-1])]
    if lower:
        part = _LOWER[part]
    return spans_hash(prefix(_BYTE[part]), starts, ends), starts, ends, counts


def grams(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that stay within a text, and the index of each one's first word."""
    if len(words) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.arange(len(words) - k + 1)
    text_end = np.repeat(counts[1:], np.diff(counts))[: len(first)]
    first = first[first + k <= text_end]
    return spans_hash(prefix(words), first, first + k), first
