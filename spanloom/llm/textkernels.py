"""Vectorised byte kernels that run inside Spark tasks on Arrow batches."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes that a kernel handles at a time; one longer text is handled alone.
CHUNK = 1 << 20
U64 = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 1 << 64)
_pow: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


#: Bytes of words: all but blanks; digits, letters and everything beyond ASCII.
NOT_BLANK = ~lut(bytes([0x20, *range(0x09, 0x0E)]))
ALNUM = lut(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def release() -> None:
    """Give back what a worker would keep until its next task: Spark reuses workers for other stages."""
    if len(_pow[0]) > CHUNK + 2:
        _pow[:] = [np.ones(1, U64), np.ones(1, U64)]
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def freeing(kernel: Callable) -> Callable:
    """The kernel of ``mapInArrow``, with ``release`` at the end of the task."""

    def run(batches):
        try:
            yield from kernel(batches)
        finally:
            release()

    return run


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for 0 to n."""
    if len(_pow[0]) <= n:
        for k, base in enumerate((_P, _INV)):
            row = np.full(max(n, CHUNK) + 1, base, U64)
            row[0] = 1
            _pow[k] = np.multiply.accumulate(row)
    return _pow


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and int64 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of at most CHUNK bytes, or one longer text: (first, end, bytes, offsets)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, "right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, and per text the index of its first word (one entry more than texts)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = table[data]
    at = off[:-1]
    at = at[(at < len(data)) & (at > 0)]
    s = w.copy()
    s[1:] &= ~w[:-1]
    s[at] = w[at]
    e = w.copy()
    e[:-1] &= ~w[1:]
    e[at - 1] = w[at - 1]
    starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
    return starts, ends, np.searchsorted(starts, off)


#: Bytes from which a word is hashed by BLAKE2, one at a time.
LONG_WORD = 512


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Keyed 64-bit hashes of words: eight bytes at a time go through a finaliser that mixes all bits.

    Unlike sums of powers modulo 2**64, no pattern of bytes cancels out.  Different seeds give
    hashes that have nothing in common, and long words are hashed by BLAKE2 under the seed."""
    if not len(starts):
        return np.zeros(0, U64)
    n = (ends - starts).astype(np.int64)
    key = mix(np.full(1, (seed * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64), U64))[0]
    lanes = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,)) if len(data) else np.zeros(0, U64)
    out = mix(n.astype(U64) ^ key)
    left = np.flatnonzero(n <= LONG_WORD)
    at, todo = starts[left].astype(np.int64), n[left]
    while len(left):
        lane = lanes[at]
        short = todo < 8
        lane[short] &= (U64(1) << (U64(8) * todo[short].astype(U64))) - U64(1)
        out[left] = mix((out[left] ^ mix(lane + key)) + U64(0x9FB21C651E98DF25))
        go = todo > 8
        left, at, todo = left[go], at[go] + 8, todo[go] - 8
    for i in np.flatnonzero(n > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=int(key).to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte spans: differences of one polynomial prefix sum, mixed with the length."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(len(data) + 1)
    if prefix is None:
        prefix = prefix_sum(data)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(U64))


def prefix_sum(data: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=out[1:])
    return out


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word runs of each text, in order, and offsets by text.

    A text of fewer words is one run; a text of none has none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    off = np.concatenate([[0], np.cumsum(count)])
    total = int(off[-1])
    if not total:
        return np.zeros(0, U64), off
    doc = np.repeat(np.arange(len(n)), count)
    at = first[:-1][doc] + (np.arange(total) - off[:-1][doc])
    last = first[1:][doc]
    out = np.full(total, 0x51ED270B0A1F39C1, U64)
    for j in range(k):
        here = at + j
        inside = here < last
        v = np.where(inside, h[np.minimum(here, len(h) - 1)], U64(0))
        out = mix(out * U64(0x9FB21C651E98DF25) + v + U64(j + 1) * inside.astype(U64))
    return out, off
