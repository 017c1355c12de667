"""Arrow text columns as numpy byte blocks of bounded size, and words in them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Block(NamedTuple):
    """Rows ``first`` to ``last`` of a column: their UTF-8 bytes, and where each begins (one more at the end)."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray


def text_blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows in order; null is empty."""
    plain = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(plain):
        return
    _, offsets, values = plain.buffers()
    offsets = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    values = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(plain):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(plain))
        yield Block(first, last, values[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value per byte."""
    return mixed(np.arange(1 + 256 * seed, 257 + 256 * seed, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        with np.errstate(over="ignore"):
            known = np.cumprod(known)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[base] = known
    return known[:n]


class RunHashes:
    """Hashes of any runs of a byte block, from prefix sums: equal runs have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray, seed: int = 0) -> None:
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(byte_values(seed)[data] * powers(_BASE, len(data)), out=self.sums[1:])
            self.back = powers(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def spaced_words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: lower-cased (A-Z) bytes of the block, starts and ends of the words, and the first word of each row (one more at the end)."""
    data = _LOWER[block.data]
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    edges = block.starts[:-1][block.starts[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return data, starts, ends, np.searchsorted(starts, block.starts)
