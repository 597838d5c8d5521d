"""Vectorised word and window hashing over Arrow string columns.

Texts of an Arrow batch are looked at as one flat UTF-8 byte array, so finding
words and hashing windows of words costs a few numpy passes for a whole batch
rather than a Python step a word.  Every function is pure and deterministic:
the same text gives the same hashes on every executor and after every retry.

Hashes are chains of avalanche steps over eight bytes at a time, and windows are
trees of such steps over their words; nothing is linear, so texts of a regular
make don't meet more often than others.  Two seeds give two independent hashes;
callers that need equality compare more bits than 64, or the bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text that one vectorised step looks at (a longer single text is one step).
STEP_BYTES = 1_500_000

_GOLD = U(0x9E3779B97F4A7C15)
_M1 = U(0xBF58476D1CE4E5B9)
_M2 = U(0x94D049BB133111EB)
#: Seeds of independent hashes.
SEEDS = tuple(U(x | 1) for x in (0xD1342543DE82EF94, 0xA0761D6478BD642E, 0xE7037ED1A0B428DA))
#: Longer spans are hashed one by one by BLAKE2.
LONG_SPAN = 256
_KEEP_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The avalanche step of splitmix64, elementwise and wrapping."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x ^= x >> U(30)
        x *= _M1
        x ^= x >> U(27)
        x *= _M2
        x ^= x >> U(31)
    return x


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes of the pattern [^\x20\x09-\x0D]+ (bytes of longer UTF-8 characters belong to words).
BLANK_SPLIT = np.ones(256, dtype=bool)
BLANK_SPLIT[[0x20, *range(0x09, 0x0E)]] = False

def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[off[0] : off[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def steps(column: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about step_bytes of text each, in order; every row is in one."""
    _, off = flat(column)
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + step_bytes, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


class Words:
    """The words of a run of texts: byte spans, the texts' first words, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, word_bytes: np.ndarray = BLANK_SPLIT):
        self.data, self.off, self._eights = data, off, None
        n = len(data)
        self.inside = inside = word_bytes[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        self.is_start = inside & (~before | edge[:-1])
        self.starts = np.flatnonzero(self.is_start)
        after = np.zeros(n, dtype=bool)
        if n:
            after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        #: Index of each text's first word; one more than there are texts.
        self.first = np.searchsorted(self.starts, off)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def left(self) -> np.ndarray:
        """How many words of its text begin at or after each word."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, seed: np.uint64 = SEEDS[0]) -> np.ndarray:
        """A hash of the bytes of each span."""
        if self._eights is None:
            padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
            self._eights = np.ndarray(len(self.data) + 1, "<u8", padded, 0, (1,))  # the eight bytes from each place on
        size = ends - starts
        h = mix(size.astype(np.uint64) ^ seed)
        on = np.flatnonzero(size <= LONG_SPAN)
        at = 0
        while len(on):
            word = self._eights[starts[on] + at] & _KEEP_BYTES[np.minimum(size[on] - at, 8)]
            h[on] = mix(h[on] ^ word)
            at += 8
            on = on[size[on] > at]
        for k in np.flatnonzero(size > LONG_SPAN):
            digest = hashlib.blake2b(self.data[starts[k] : ends[k]].tobytes(), digest_size=8, key=int(seed).to_bytes(8, "little")).digest()
            h[k] = np.frombuffer(digest, "<u8")[0]
        return h

    def hashes(self, seed: np.uint64 = SEEDS[0]) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends, seed)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes; entry i begins at word i (texts aren't told apart)."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    both = lambda a, b: mix(a * SEEDS[2] + b)
    with np.errstate(over="ignore"):
        out, done, run, size = None, 0, hashes, 1  # run: windows of `size` words
        while True:
            if k & size:
                out, done = (run if out is None else both(out[: len(run) - done], run[done:])), done + size
            if done == k:
                return out[: n - k + 1]
            run, size = both(run[:-size], run[size:]), 2 * size


def spans_equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes from a[i] and from b[i] on are the same, size[i] of them."""
    ok = np.ones(len(size), dtype=bool)
    for lo in range(0, len(size), 1 << 16):
        n = size[lo : lo + (1 << 16)]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        differ = data[np.repeat(a[lo : lo + (1 << 16)], n) + within] != data[np.repeat(b[lo : lo + (1 << 16)], n) + within]
        ok[lo + np.repeat(np.arange(len(n)), n)[differ]] = False
    return ok


def runs_of_equal(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indexes of keys that occur at least twice, of those that repeat an earlier one, and for these the one before."""
    if len(keys) < 2:
        return (np.zeros(0, np.int64),) * 3
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    again = np.concatenate([[False], same])
    return order[again | np.concatenate([same, [False]])], order[again], order[:-1][same]
