"""Count-min sketches of hashes: built a partition at a time, merged by cell range, broadcast as bits.

A task counts its hashes in sorted, delta-coded cell lists and ships them by slice of the cell
range; one pass over a slice adds them with saturation, in as many tasks as the input asks for. What comes back is, for each row of
the sketch and each threshold, one bit a cell: at least that many. Its size is fixed by ``bits``
and ``rows`` and not by the data, so it may be broadcast. With more distinct hashes than cells
it tells less apart; an estimate is never below the true count, so nothing is ever lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pigeonhole.llm.text import give_back, mix

#: Slices of the cell range at most, so many for each row of the sketch.
SLICES = 1024
#: For thresholds after the first, cells are taken together in this power of two: fewer bits, still never too low.
FOLD = 3
#: Cells of a slice at least.
LEAST_CELLS = 64
#: Tasks that merge, each a share of the cells: so many for each task that counts, and at least this number.
MERGERS_A_TASK, LEAST_MERGERS = 2, 32
FLUSH = 1_000_000


class Sketch:
    """Lookups in the merged sketch."""

    def __init__(self, bits: int, rows: int, thresholds: tuple[int, ...], maps: dict[tuple[int, int], np.ndarray]):
        self.bits, self.rows, self.thresholds, self.maps = bits, rows, thresholds, maps

    def __getstate__(self) -> dict:
        # Most bits are unset: a broadcast, of which each executor holds a file, is packed.
        return self.__dict__ | {"maps": {k: zlib.compress(m.tobytes(), 1) for k, m in self.maps.items()}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"maps": {k: np.frombuffer(zlib.decompress(m), np.uint8) for k, m in state["maps"].items()}}

    def at_least(self, hashes: np.ndarray, level: int = 0) -> np.ndarray:
        """Whether each hash is estimated to have ``thresholds[level]`` occurrences or more."""
        out = np.ones(len(hashes), bool)
        for row in range(self.rows):
            cell = cells(hashes, row, self.bits) >> (FOLD if level else 0)
            out &= (self.maps[row, level][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
        return out


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(hashes ^ np.uint64((row + 1) * 0xD1342543DE82EF95 % (1 << 64))) >> np.uint64(64 - bits)).astype(np.int64)


def _pack(cell: np.ndarray) -> tuple[bytes, bytes]:
    """Differences of sorted numbers as bytes, and those of 255 and more apart."""
    step = np.diff(cell, prepend=0)
    return np.minimum(step, 255).astype(np.uint8).tobytes(), step[step >= 255].astype(np.uint32).tobytes()


def _unpack(low: bytes, high: bytes) -> np.ndarray:
    step = np.frombuffer(low, np.uint8).astype(np.int64)
    step[step == 255] = np.frombuffer(high, np.uint32)
    return np.cumsum(step)


def mergers(tasks: int, slots: int) -> int:
    """How many tasks merge what so many tasks have counted."""
    return min(slots, max(LEAST_MERGERS, MERGERS_A_TASK * tasks))


Hashes = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


def build(df: DataFrame, hashes_of: Hashes, bits: int, rows: int, thresholds: tuple[int, ...] = (2,)) -> Sketch:
    """The sketch of all hashes that ``hashes_of`` yields for the batches of ``df``."""
    return merged([(df, hashes_of)], bits, rows, thresholds)


def merged(sources: list[tuple[DataFrame, Hashes]], bits: int, rows: int, thresholds: tuple[int, ...] = (2,)) -> Sketch:
    """The sketch of the hashes of several tables, each with its own way to get them."""
    slices = max(1, min(SLICES, (1 << bits) // LEAST_CELLS))
    size = (1 << bits) // slices

    def counter(hashes_of: Hashes):
        return lambda batches: count(hashes_of(batches))

    def count(hashes: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
            h, out = np.concatenate(parts), []
            for row in range(rows):
                cell = np.sort(cells(h, row, bits))
                new = np.flatnonzero(np.diff(cell, prepend=-1))
                n = np.minimum(np.diff(np.append(new, len(cell))), 255).astype(np.uint8)
                cell = cell[new]
                ends = np.searchsorted(cell, np.arange(slices + 1) * size)
                for k in np.flatnonzero(np.diff(ends)).tolist():
                    own = slice(ends[k], ends[k + 1])
                    out.append((row * slices + k, *_pack(cell[own] - k * size), zlib.compress(n[own].tobytes(), 1)))
            names, kinds = ["slot", "low", "high", "n"], [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        held, total = [], 0
        for h in hashes:
            if len(h):
                held.append(h)
                total += len(h)
            if total >= FLUSH:
                yield flush(held)
                held, total = [], 0
        if total:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for slot, low, high, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if slot not in sums:
                    sums[slot] = np.zeros(size, np.uint8)
                cell, add = _unpack(low, high), np.frombuffer(zlib.decompress(n), np.uint8)
                sums[slot][cell] = np.minimum(sums[slot][cell].astype(np.int32) + add, 255)
        for slot, total in sums.items():
            folded = total.reshape(-1, 1 << FOLD).max(1)
            made = [zlib.compress(np.packbits((folded if k else total) >= t).tobytes(), 1) for k, t in enumerate(thresholds)]
            arrays = [pa.array([slot] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["slot", "level", "bits"])
        give_back()

    parts = [df.mapInArrow(counter(h), "slot int, low binary, high binary, n binary") for df, h in sources]
    count_tasks = sum(df.rdd.getNumPartitions() for df, _ in sources)
    sums = reduce(DataFrame.unionByName, parts).repartition(mergers(count_tasks, slices * rows), "slot").mapInArrow(merge, "slot int, level int, bits binary")
    maps = {}
    for row in range(rows):
        for level in range(len(thresholds)):
            maps[row, level] = np.zeros((1 << bits) // 8 >> (FOLD if level else 0), np.uint8)
    for r in sums.collect():  # a bounded number of bytes, whatever the data
        row, k = divmod(r["slot"], slices)
        own = np.frombuffer(zlib.decompress(bytes(r["bits"])), np.uint8)
        maps[row, r["level"]][k * len(own) : (k + 1) * len(own)] = own
    return Sketch(bits, rows, thresholds, maps)
