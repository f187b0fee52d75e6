"""Texts of a batch as flat byte arrays, and word boundaries and word
fingerprints on them, without a Python step per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# odd multiplier of the polynomial and its inverse modulo 2**64
_P = 0x9E3779B97F4A7C15 & ~7 | 5
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20250701)).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# bytes that belong to a word
WORD_NOT_SPACE = np.ones(256, bool)
WORD_NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
WORD_ALNUM = np.zeros(256, bool)
WORD_ALNUM[0x30:0x3A] = True
WORD_ALNUM[0x61:0x7B] = True
WORD_ALNUM[0x80:] = True

_powers = (np.ones(1, U64), np.ones(1, U64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 1 << 16)
        out = []
        for base in (_P, _P_INV):
            with np.errstate(over="ignore"):
                a = np.ones(n, U64)
                a[1:] = U64(base)
                np.multiply.accumulate(a, out=a)
            out.append(a)
        _powers = (out[0], out[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mixer on 64-bit values (bijective)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def chunks(texts: list, max_bytes: int) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive texts of about
    ``max_bytes``, joined by newlines; a longer text is a chunk of its own.
    offsets[i] is the start of text i, offsets[-1] one newline past the end."""
    first, size, parts = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if parts and size + len(b) > max_bytes:
            yield first, i, b"\n".join(parts) + b"\n", _offsets(parts)
            first, size, parts = i, 0, []
        parts.append(b)
        size += len(b) + 1
    if parts:
        yield first, len(texts), b"\n".join(parts) + b"\n", _offsets(parts)


def _offsets(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))])


def lowered(data: bytes) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _LOWER[np.frombuffer(data, np.uint8)]


def words(low: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes; the last byte of
    ``low`` is a newline, so every run ends inside."""
    w = kind[low]
    edge = np.flatnonzero(w[1:] != w[:-1]) + 1
    if len(w) and w[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


#: Bytes over which prefix sums are taken at once; tables are as long.
PIECE = 1 << 22


def fingerprints(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each of the byte ranges, which follow each other,
    by prefix sums of a polynomial. It depends on a range's bytes alone, so
    long arrays are worked on piece by piece, in bounded memory."""
    if len(low) > PIECE:
        out, at = np.empty(len(starts), U64), 0
        while at < len(starts):
            to = int(np.searchsorted(ends, starts[at] + PIECE, "right"))
            if to > at:
                a, z = starts[at], ends[to - 1]
                out[at:to] = fingerprints(low[a:z], starts[at:to] - a, ends[at:to] - a)
            else:  # one range longer than a piece
                to = at + 1
                out[at] = _long_fingerprint(low[starts[at] : ends[at]])
            at = to
        return out
    up, down = _power_tables(len(low) + 1)
    acc = np.zeros(len(low) + 1, U64)
    np.cumsum(_BYTE[low] * up[: len(low)], out=acc[1:])
    return mix((acc[ends] - acc[starts]) * down[starts])


def _long_fingerprint(low: np.ndarray) -> np.uint64:
    up, _ = _power_tables(PIECE)
    total = 0
    for at in range(0, len(low), PIECE):
        part = low[at : at + PIECE]
        total += int((_BYTE[part] * up[: len(part)]).sum(dtype=U64)) * pow(_P, at, 1 << 64)
    return mix(np.array([total & (1 << 64) - 1], U64))[0]


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of every k consecutive 64-bit values (len - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out = out * U64(_P) + values[j : j + n]
    return mix(out)


#: Rows that become Python objects at a time.
ROWS = 1024


def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with rows, cut to at most ``ROWS``; after the last the
    worker gives free memory back, since it may idle beside others."""
    for b in it:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)
    give_back()


def give_back() -> None:
    """Return what Arrow and the C library hold free to the system, where they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
