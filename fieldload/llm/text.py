"""Words, shingles and windows of Arrow text columns as numpy arrays.

A batch's UTF-8 bytes are cut into words by a byte table, and every word,
run of ``k`` words or longer stretch gets a 64-bit hash, so no Python object is
made per word.  Words are hashed eight bytes at a time and runs by doubling,
with a finisher that is not linear between the steps: a polynomial modulo 2**64
would have colliding texts for every base.  Texts are processed whole: a chunk
ends only between rows, and a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once (a longer single text is still whole).
CHUNK_BYTES = 1 << 18
# Words of more bytes are hashed one by one.
LONG_WORD = 64

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407))
# The lowest 0 to 8 bytes of a lane.
_LANE = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def space_words() -> np.ndarray:
    """Byte table of ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = False
    return t


def alnum_words() -> np.ndarray:
    """Byte table of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = t[0x80:] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and bytes of a string column; null reads as empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


class Words:
    """Words of rows ``lo`` to ``hi`` of a batch; row ``lo + r`` starts at word ``woff[r]`` and byte ``boff[r]``."""

    def __init__(self, lo, hi, data, starts, ends, boff, woff, hashes):
        self.lo, self.hi, self.data, self.boff = lo, hi, data, boff
        self.starts, self.ends, self.woff, self.hashes = starts, ends, woff, hashes
        self.counts = np.diff(woff)

    def __len__(self):
        return len(self.starts)

    def starts_of(self, k: int) -> np.ndarray:
        """First words of all runs of ``k`` words inside one row."""
        row_end = np.repeat(self.woff[1:], self.counts)
        return np.flatnonzero(np.arange(len(self)) + k <= row_end)

    def rows_of(self, words: np.ndarray) -> np.ndarray:
        """Row (from 0 at ``lo``) of each word."""
        return np.searchsorted(self.woff, words, "right") - 1

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the byte strings ``starts`` to ``ends``."""
    n = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    h = mix(n.astype(np.uint64) * _A + np.uint64(seed))
    for at in range(0, min(int(n.max(initial=0)), LONG_WORD), 8):
        some = np.flatnonzero(n > at)
        lane = lanes[starts[some] + at] & _LANE[np.minimum(n[some] - at, 8)]
        h[some] = mix(h[some] * _B + lane)
    for i in np.flatnonzero(n > LONG_WORD):
        word = data[starts[i] : ends[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return h


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _B + ((b << np.uint64(23)) | (b >> np.uint64(41))))


class Tokenizer:
    """Cuts batches into chunks of words; make one per task."""

    def __init__(self, is_word: np.ndarray, lower: bool, seed: int = 1):
        self.is_word, self.seed = is_word, seed
        self.lower = lower_table() if lower else None

    def _hashes(self, data, starts, ends, seed) -> np.ndarray:
        return hash_words(data if self.lower is None else self.lower[data], starts, ends, seed)

    def second(self, words: Words) -> Words:
        """The same words under independent hashes of their bytes."""
        other = self._hashes(words.data, words.starts, words.ends, self.seed + 0x51ED2701)
        return Words(words.lo, words.hi, words.data, words.starts, words.ends, words.boff, words.woff, other)

    def chunks(self, column: pa.Array) -> Iterator[Words]:
        off, data = strings(column)
        lo, n = 0, len(off) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK_BYTES, "right")) - 1)
            yield self._cut(lo, min(hi, n), off, data)
            lo = min(hi, n)

    def _cut(self, lo, hi, off, data) -> Words:
        b = data[off[lo] : off[hi]]
        rel = off[lo : hi + 1] - off[lo]
        w = self.is_word[b]
        first, last = w.copy(), w.copy()
        first[1:] &= ~w[:-1]
        last[:-1] &= ~w[1:]
        inner = rel[1:-1]
        inner = inner[(inner > 0) & (inner < len(b))]
        first[inner] = w[inner]
        last[inner - 1] = w[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes = self._hashes(b, starts, ends, self.seed)
        return Words(lo, hi, b, starts, ends, rel, np.searchsorted(starts, rel), hashes)

    def runs(self, words: Words, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the word sequences ``starts`` to ``ends`` (word indices, end exclusive).

        A run is its first and last ``2 ** j`` words, which overlap or meet.
        """
        n = ends - starts
        longest = int(n.max(initial=0))
        out = np.zeros(len(starts), np.uint64)
        h, size = words.hashes, 1
        while size <= longest:
            if size * 2 > longest and int(n.min(initial=longest)) >= size:
                some = slice(None)
            else:
                some = np.flatnonzero((n >= size) & (n < size * 2))
            length = n[some].astype(np.uint64) * _C
            out[some] = mix(_joint(h[starts[some]], h[ends[some] - size]) + length)
            if size * 2 > longest:
                break
            h = _joint(h[:-size], h[size:])
            size *= 2
        return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    size, m = 1, x
    while size * 2 <= width:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    return np.minimum(m[:n], m[width - size : width - size + n])
