"""Vectorised text primitives on Arrow buffers: words, hashes, intervals, blobs.

All functions work on the UTF-8 bytes of a whole Arrow batch, cut into chunks
of whole texts, so memory follows the chunk size and not the corpus.
"""

from __future__ import annotations

import ctypes
import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEED, _STEP, _LONG = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93), 16  # blocks of 8 bytes hashed by numpy
_MULTIPLIERS = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 4096, dtype=np.uint64) | U64(1)
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

SPACE = np.ones(256, bool)  # words are runs of anything but ASCII white space
SPACE[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)  # words are runs of ASCII letters, digits and all non-ASCII
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def column_bytes(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as the empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, most: int = 1_000_000):
    """Ranges of whole texts holding about ``most`` bytes each; afterwards freed memory goes back.

    Workers outlive their stage, so what one stage held must not stay with the next.
    """
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
    if n and offs[-1] > most:
        release()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; returns a new array."""
    t = x >> U64(30)
    x = x ^ t
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, U64(27), out=t)
    x *= U64(0x94D049BB133111EB)
    x ^= np.right_shift(x, U64(31), out=t)
    return x


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number; zeros follow the end.  A view of a padded copy."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 8,), "<u8", padded, 0, (1,))


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), the same wherever the bytes lie.

    Blocks of 8 bytes are chained through a non-linear mixer, so no arrangement
    of letters cancels out as in a polynomial; spans of more than 128 bytes go
    to BLAKE2b.  Two given different spans are equal with probability 2**-64.
    """
    size = ends - starts
    x = eights(data)
    h = mix(size.astype(U64) * _STEP + _SEED)
    live, at, left = slice(None), starts, size
    for _ in range(_LONG):
        h[live] = mix(h[live] ^ (x[at] & _LOW_BYTES[np.minimum(left, 8)])) * _STEP
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > 8 * _LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(h)


def word_spans(data: np.ndarray, offs: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and each text's first word."""
    n = len(data)
    w = keep[data]
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:] = w[:-1]
        after[:-1] = w[1:]
        full = offs[1:] > offs[:-1]
        before[offs[:-1][full]] = False
        after[offs[1:][full] - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def words(data: np.ndarray, offs: np.ndarray, keep: np.ndarray = SPACE, lower: bool = True):
    """Hashes, starts and ends of words, and each text's first word."""
    starts, ends, first = word_spans(data, offs, keep)
    return byte_hash(LOWER[data] if lower else data, starts, ends), starts, ends, first


def multipliers(k: int) -> np.ndarray:
    """Fixed random odd numbers, one for each place of a sequence."""
    return _MULTIPLIERS[:k] if k <= len(_MULTIPLIERS) else np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, k, dtype=np.uint64) | U64(1)


def grams(h: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the k values from each position on, or from those given; len(h) - k + 1 of them."""
    n = len(h) - k + 1 if at is None else len(at)
    if n <= 0:
        return np.zeros(0, U64)
    g = np.full(n, U64(k))
    for j, m in enumerate(multipliers(k)):
        g += (h[j : j + n] if at is None else h[at + j]) * m
    return mix(g)


def byte_grams(data: np.ndarray, q: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the q bytes from each position on, or from those given; len(data) - q + 1 of them."""
    n = len(data) - q + 1 if at is None else len(at)
    if n <= 0:
        return np.zeros(0, U64)
    x, g = eights(data), np.full(n, U64(q))
    for j, m in zip(range(0, q, 8), multipliers(-(-q // 8)), strict=True):
        v = x[j : j + n] if at is None else x[at + j]
        g += v * m if q - j >= 8 else (v & _LOW_BYTES[q - j]) * m
    return mix(g)


def sequence_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values in each span [start, end)."""
    size = ends - starts
    out = size.astype(U64)
    live = np.arange(len(starts))
    for j, m in enumerate(multipliers(int(size.max()) if len(size) else 0)):
        live = live[size[live] > j]
        out[live] += h[starts[live] + j] * m
    return mix(out)


def owner(first: np.ndarray) -> np.ndarray:
    """Index of the text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values over each text's range."""
    c = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions of 0..n-1 inside any interval."""
    d = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(d)[:n] > 0


def pack(_level: int = 1, **arrays: np.ndarray) -> bytes:
    """Arrays of one message, compressed; read with ``unpack``."""
    b = pa.BufferOutputStream()
    codec = pa.Codec("zstd", _level)
    head, bodies = [], []
    for k, a in arrays.items():
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.size else b""
        z = codec.compress(raw, asbytes=True) if raw else b""
        head.append(f"{k},{a.dtype.str},{a.size},{len(z)}")
        bodies.append(z)
    line = ";".join(head).encode()
    b.write(len(line).to_bytes(4, "little"))
    b.write(line)
    for z in bodies:
        b.write(z)
    return b.getvalue().to_pybytes()


def unpack(blob) -> dict[str, np.ndarray]:
    blob = memoryview(blob)
    n = int.from_bytes(blob[:4], "little")
    at, out, codec = 4 + n, {}, pa.Codec("zstd")
    for x in bytes(blob[4:at]).decode().split(";"):
        k, kind, size, z = x.split(",")
        kind, size, z = np.dtype(kind), int(size), int(z)
        if size:
            raw = codec.decompress(pa.py_buffer(blob[at : at + z]), size * kind.itemsize, asbytes=True)
            out[k] = np.frombuffer(raw, np.uint8).reshape(kind.itemsize, size).T.copy().view(kind).ravel()
        else:
            out[k] = np.zeros(0, kind)
        at += z
    return out


def pack_sorted(keys: np.ndarray) -> np.ndarray:
    """Differences of ascending 64-bit keys, which compress better."""
    return np.diff(keys, prepend=U64(0))


def unpack_sorted(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d, dtype=U64)


def dense_ranks(x: np.ndarray) -> np.ndarray:
    """Ranks 0, 1, ... of equal values, in their order."""
    order = np.argsort(x)
    y = x[order]
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], y[1:] != y[:-1]])) if len(x) else out
    return out


def release() -> None:
    """Give freed memory of a Python worker back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
