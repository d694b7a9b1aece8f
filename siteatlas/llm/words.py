"""Words and word n-grams of many texts at once, as numpy arrays over one byte buffer.

A batch of texts is handled as the concatenation of their UTF-8 bytes. A word is a maximal run of bytes of
a given class that does not leave its text; its hash is a polynomial over its bytes, so neither splitting
nor hashing has a loop over words. Batches are cut at text borders, a long text is a batch of its own, so
memory is bounded by the longest text and not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siteatlas.session import ARROW_BYTES, bound_arrow_batches  # noqa: F401

BATCH_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_LOW = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: A random 64-bit value for every byte, and the same with A-Z taken as a-z.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_folded = np.arange(256)
_folded[65:91] += 32
BYTE_FOLDED = BYTE[_folded]
FOLD = _folded.astype(np.uint8)

_POWERS = _geometric(_MULTIPLIER, _LOW)
_INVERSES = _geometric(_INVERSE, _LOW)


def powers(n: int) -> np.ndarray:
    """Powers 0 to n - 1 of the multiplier."""
    global _POWERS
    if n > len(_POWERS):
        if n > 4 * BATCH_BYTES:  # for one long text; not kept
            return _geometric(_MULTIPLIER, n)
        _POWERS = _geometric(_MULTIPLIER, n)
    return _POWERS[:n]


def inverse_power(at: np.ndarray) -> np.ndarray:
    """The multiplier to the power of -at, for any positions."""
    high = at >> 16
    big = pow(_INVERSE, _LOW, 1 << 64)
    return _INVERSES[at & (_LOW - 1)] * _geometric(big, int(high.max(initial=0)) + 1)[high]


def byte_class(members: str) -> np.ndarray:
    """A table of 256 flags; ``members`` lists byte ranges as in ``"00-2F 3A-60"``."""
    flags = np.zeros(256, bool)
    for part in members.split():
        low, _, high = part.partition("-")
        flags[int(low, 16) : int(high or low, 16) + 1] = True
    return flags


#: Words as runs of anything but ASCII white space: ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~byte_class("20 09-0D")
#: Words as runs of ASCII letters, digits and all non-ASCII bytes: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, after lower-casing.
ALNUM = ~byte_class("00-2F 3A-40 5B-60 7B-7F")


def prefix_hash(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """H with H[j] - H[i] the polynomial of bytes i to j - 1, still scaled by the power i."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(table[data] * powers(len(data)), out=out[1:])
    return out


class Texts:
    """Some texts as bytes ``data`` with ``offsets``; ``first`` is the row of the first one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int = 0):
        self.data, self.offsets, self.first = data, offsets, first
        self.n = len(offsets) - 1

    def words(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word, and where each text's words begin (n + 1 counts)."""
        flags = letters[self.data]
        at_start, at_end = flags.copy(), flags.copy()
        at_start[1:] &= ~flags[:-1]
        at_end[:-1] &= ~flags[1:]
        inner = self.offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(flags))]
        at_start[inner] = flags[inner]
        at_end[inner - 1] = flags[inner - 1]
        starts, ends = np.flatnonzero(at_start), np.flatnonzero(at_end) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, letters: np.ndarray, table: np.ndarray = BYTE_FOLDED) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of every word, and where each text's words begin."""
        starts, ends, bounds = self.words(letters)
        if not len(starts):
            return np.empty(0, np.uint64), bounds
        h = prefix_hash(self.data, table)
        value = (h[ends] - h[starts]) * inverse_power(starts)
        return mix(value + (ends - starts).astype(np.uint64)), bounds


def buffer_of(texts: pa.Array) -> Texts:
    """All texts of an Arrow string or binary array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = pa.large_binary()
    texts = pc.fill_null(texts.cast(kind), pa.scalar(b"", kind))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def batches(texts: pa.Array, rows: int, size: int = BATCH_BYTES) -> Iterator[Texts]:
    """The texts in runs of at most ``rows`` rows and, but for single long texts, ``size`` bytes."""
    whole = buffer_of(texts)
    at = 0
    while at < whole.n:
        fits = int(np.searchsorted(whole.offsets, whole.offsets[at] + size, side="right")) - 1
        to = min(max(fits, at + 1), at + rows, whole.n)
        low, high = whole.offsets[at], whole.offsets[to]
        yield Texts(whole.data[low:high], whole.offsets[at : to + 1] - low, at)
        at = to


def owner(bounds: np.ndarray) -> np.ndarray:
    """For n + 1 bounds, the index of the text that each element belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


_COMBINE = mix(np.arange(101, 165, dtype=np.uint64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive elements, borders of texts ignored; len - k + 1 values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += (hashes[i : i + n] ^ _COMBINE[i % 64]) * (_COMBINE[(i + 7) % 64] | np.uint64(1))
    return mix(out)
