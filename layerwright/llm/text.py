"""Words of whole texts, found and hashed with numpy over Arrow buffers.

A task sees its texts as one byte array with document offsets, in blocks of about
a quarter of a megabyte (a longer document is a block of its own), so memory is bounded
by the block and no Python object is made per word.  Separators are ASCII bytes:
every byte of a longer UTF-8 character belongs to a word, so cutting bytes cuts
characters the same way.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
CHUNK = 1 << 16

# Separator bytes of the two word patterns.
SPACE = np.zeros(256, bool)  # words are [^\x20\x09-\x0D]+
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)  # words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MASK = (1 << 64) - 1
_BYTE_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WORD_BASES = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, for n up to CHUNK + 1; the table is kept, and so small whatever the texts."""
    if base not in _POWERS:
        table = np.full(CHUNK + 1, base, np.uint64)
        table[0] = 1
        _POWERS[base] = np.cumprod(table)
    return _POWERS[base][:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=out[1:])
    return out


def rolling(values: np.ndarray, base: int, begin: np.ndarray, end: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Rabin-Karp hash of values[begin:end] for many spans at once, from prefix sums modulo 2**64.

    `begin` and `end` ascend.  The spans are worked off a chunk of values at a time, so
    the eight-byte tables follow the chunk and not the text; `table` maps values to
    their numbers there.  A span longer than a chunk is summed up chunk by chunk.
    """
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        low = int(begin[i])
        j = max(i + 1, int(np.searchsorted(end, low + CHUNK, "right")))
        if int(end[i]) - low > CHUNK:
            out[i] = _long_span(values, base, low, int(end[i]), table)
            i += 1
            continue
        j = min(j, len(begin))
        part = values[low : int(end[j - 1])]
        part = part if table is None else table[part]
        sums = prefix_sums(part * powers(base, len(part)))
        out[i:j] = (sums[end[i:j] - low] - sums[begin[i:j] - low]) * powers(inverse(base), len(part) + 1)[begin[i:j] - low]
        i = j
    return mix(out)


def _long_span(values: np.ndarray, base: int, begin: int, end: int, table: np.ndarray | None) -> int:
    total, step = 0, 1
    for at in range(begin, end, CHUNK):
        part = values[at : min(at + CHUNK, end)]
        part = part if table is None else table[part]
        total = (total + step * int((part * powers(base, len(part))).sum(dtype=np.uint64))) & _MASK
        step = step * pow(base, CHUNK, 1 << 64) & _MASK
    return total


@dataclass
class Words:
    """Words of a block: byte spans, the document of each, and each document's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # documents + 1 entries

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, variant: int = 0) -> np.ndarray:
        return rolling(self.data, _BYTE_BASES[variant], self.starts, self.ends, _BYTE_VALUES)

    def windows(self, hashes: np.ndarray, size: int, variant: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of `size` words inside one document."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, rolling(hashes, _WORD_BASES[variant], at, at + size)

    def joined(self, first: int, size: int) -> bytes:
        """The words as bytes with one space between them."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[first : first + size], self.ends[first : first + size]))


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = False) -> Words:
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    n = len(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, np.flatnonzero(stops) + 1, doc, first)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string or binary column; NULL reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(kind)
    width = np.int64 if pa.types.is_large_binary(kind) else np.int32
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a partition in blocks of at most `limit` text bytes (one row at least): batch, bytes, offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_buffers(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1)
            yield batch.slice(begin, end - begin), data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
            begin = end
        del batch, data, offsets
    give_back()


def give_back() -> None:
    """Return memory that a worker has freed to the system: at the end of a partition, since workers are kept for later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def sliding(ufunc: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of each run of `width` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = ufunc(out[: len(out) - step], out[step:])
        have += step
    return out
