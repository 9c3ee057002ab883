"""Words of many texts at once: spans and 64-bit hashes by numpy over the bytes of an Arrow batch.

Runs inside tasks. White space is the six ASCII characters ``[\\x20\\x09-\\x0D]``; everything else
belongs to a word, so UTF-8 sequences are never cut. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20  # texts are taken in blocks of about this many bytes; a longer text is a block of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers: of bytes in a word, of words in a run
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, inverse: bool, n: int) -> np.ndarray:
    """base**i (or its inverse) modulo 2**64 for i below n."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        root = pow(base, -1, 1 << 64) if inverse else base
        steps = np.full(max(n, BLOCK_BYTES + 1), root, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 * BLOCK_BYTES:
            _powers[base, inverse] = have
    return have[:n]


def _run_hashes(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of values[start:end] for every pair, by differences of one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, False, len(values)), out=total[1:])
    return (total[ends] - total[starts]) * _power(base, True, len(values) + 1)[starts]


@dataclass
class Block:
    """Some whole texts. Words of text i are ``first[i]:first[i + 1]`` of the arrays below."""

    at: int  # row of the first text in its batch
    data: np.ndarray  # bytes of the texts, one after the other
    bounds: np.ndarray  # text i is data[bounds[i]:bounds[i + 1]]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def word_hashes(self, seed: int = 0) -> np.ndarray:
        h = _run_hashes(_BYTE[self.data], _BASE[0], self.starts, self.ends)
        return mixed(h ^ ((self.ends - self.starts).astype(np.uint64) * np.uint64(2 * seed + 0xD6E8FEB86659FD93)))

    def gram_hashes(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words inside one text, and where each text's runs begin."""
        n = np.maximum(np.diff(self.first) - k + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(n)])
        starts = np.arange(bounds[-1]) + np.repeat(self.first[:-1] - bounds[:-1], n)
        return mixed(_run_hashes(words, _BASE[1], starts, starts + k)), bounds

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[Block]:
    """The texts of a column as blocks of bounded size. ``lower`` folds A-Z only."""
    if len(column) == 0:
        return
    data, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        end = min(end, len(column))
        part = data[offsets[at] : offsets[end]]
        bounds = offsets[at : end + 1] - offsets[at]
        yield _block(at, _LOWER[part] if lower else part, bounds)
        at = end


def _block(at: int, data: np.ndarray, bounds: np.ndarray) -> Block:
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Block(at, data, bounds, starts, ends, np.searchsorted(starts, bounds))
