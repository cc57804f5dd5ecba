"""Vectorised helpers over Arrow columns: byte views, words, hashes, bounded pieces of batches.

All of this runs inside Spark tasks on one Arrow batch at a time. A batch is worked on in
pieces of a few MB, so that temporary arrays stay small whatever a batch holds; a single text
larger than that forms a piece of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public SplitMix64 generator, on unsigned 64-bit values."""
    x = (x + U64(0x9E3779B97F4A7C15)).astype(U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings on end, and where each starts and the last ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def give_back() -> None:
    """Return freed memory to the system, as Python workers wait for their next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES, rows: int = 1 << 30
) -> Iterator[pa.RecordBatch]:
    """All rows of batches in pieces of up to ``rows``, whose texts have about ``limit`` bytes at most."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(at, at[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


#: Word bytes are all but blank and 0x09 to 0x0D.
WORD_BYTE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: Lower-cases A-Z and leaves other bytes.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class Words:
    """Words of flat texts: first and past-the-end byte, and the first word of each text."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        inside = WORD_BYTE[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = at[1:-1]
            begins = edges[edges < len(data)]
            first[begins] = inside[begins]
            ends = edges[edges > 0] - 1
            last[ends] = inside[ends]
        self.data, self.inside = data, inside
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.of_doc = np.searchsorted(self.starts, at)  # word offsets, one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of_doc)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """64-bit hashes: the sum over bytes of a random value for byte and place in the word."""
        return span_hashes(self.data[self.inside], self.ends - self.starts, lane)


_PLACES = 64
_TABLES: dict[int, np.ndarray] = {}


def _table(lane: int) -> np.ndarray:
    if lane not in _TABLES:
        _TABLES[lane] = mix(np.arange(_PLACES * 256, dtype=U64) + U64((lane + 1) << 40))
    return _TABLES[lane]


def span_hashes(data: np.ndarray, lengths: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hashes of spans that lie on end in ``data``; none is empty."""
    if len(lengths) == 0:
        return np.zeros(0, U64)
    begin = np.cumsum(lengths) - lengths
    small = np.int32 if len(data) < 1 << 22 else np.int64
    place = np.arange(len(data), dtype=small)
    place -= np.repeat(begin.astype(small), lengths)
    key = place * small(256) + data
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        rest = mix(key[far].astype(U64) + U64((lane + 1) << 40))
        key[far] = 0
        value = _table(lane)[key]
        value[far] = rest
    else:
        value = _table(lane)[key]
    return mix(np.add.reduceat(value, begin) ^ lengths.astype(U64))


#: Odd bases of the rolling hashes, one a lane, and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(lane)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        up, down = np.full(size, BASES[lane], U64), np.full(size, pow(BASES[lane], -1, 1 << 64), U64)
        up[0] = down[0] = 1
        _POWERS[lane] = have = (np.cumprod(up), np.cumprod(down))
    return have


def rolling(values: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` values, by its start, whatever lies around it."""
    n = len(values)
    if n < width:
        return np.zeros(0, U64)
    up, down = _powers(lane, n)
    total = np.zeros(n + 1, U64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * down[: n - width + 1])


def spanning(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of values[start:stop] for each pair, whatever lies around it."""
    up, down = _powers(lane, len(values))
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[stops] - total[starts]) * down[starts] ^ (stops - starts).astype(U64))


def starts_within(of_doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``width`` items within one text, and the texts they are in."""
    room = np.maximum(np.diff(of_doc) - width + 1, 0)
    doc = np.repeat(np.arange(len(room)), room)
    return np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room) + np.repeat(of_doc[:-1], room), doc


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` gram hashes the place of its least one, the first of equal ones.

    The place within the run depends on its content alone. The low half of a key is its place,
    so a piece may have up to 2^32 grams.
    """
    n = len(grams)
    key = (grams & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    have, least = 1, key
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return (least & U64(0xFFFFFFFF)).astype(np.int64)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal rows begins."""
    if len(columns[0]) == 0:
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow binary values of the given byte lengths that lie on end in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    raw = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
