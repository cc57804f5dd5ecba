"""Which texts may have three quarters of their tokens in common with another: a filter that grows with the input.

Two texts that link have all but a quarter of the tokens of either in common, so a text that has more
tokens of its own than that links with none. To tell, it is enough to look at the tokens below a fixed
share of the hash range. They are dealt by slices of that range, as many as the tokens ask for, so what a
task holds does not grow with the input and neither does the share of tokens that look common by chance.

1. A task takes texts together into chunks. A token that comes twice in a chunk is common. Each slice
   gets a chunk's tokens once, as sorted, delta-coded hashes with the number of their text.
2. Where a slice meets, hashes that only one chunk has there belong to one text; they are counted by text.
3. The counts of a chunk come together again with its ids, hashes and sizes.

Hashes are cut to ``CELL_BITS`` within a slice. Tokens that fall together count as common, so the
filter lets some texts more through and never holds back one that links.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.repeats import DistinctTexts
from pigeonhole.llm.text import flat, give_back, pieces, runs

#: Tokens are looked at if their hash is in the lower half: its top bit is 0.
LOOK_BITS = 63
#: Tokens a chunk and texts a chunk at most (but one text is never cut).
CHUNK_TOKENS, CHUNK_TEXTS = 1_000_000, 60_000
#: Bits of a hash that are kept within a slice, and bytes of text that make one slice (some two million tokens to look at).
CELL_BITS, SLICE_BYTES = 26, 32 << 20
LEAST_SLICES, SLICES_A_TASK = 128, 4
#: Number of a token's text where a chunk has it in several.
_SEVERAL = 0xFFFF

_DEALT = "slot int, chunk bigint, low binary, high binary, owner binary, ids array<bigint>, shas array<binary>, sizes array<bigint>"
_COUNTS = "chunk bigint, lone binary, ids array<bigint>, shas array<binary>, sizes array<bigint>, first boolean"

TokenSets = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def slices(text_bytes: int) -> int:
    """How many slices the tokens of so many bytes of text are dealt into, a power of two."""
    return max(LEAST_SLICES, 1 << (-(-text_bytes // SLICE_BYTES) - 1).bit_length())


def _coded(cell: np.ndarray) -> tuple[bytes, bytes]:
    """Differences of sorted numbers in two bytes, and those that need more apart."""
    step = np.diff(cell, prepend=0)
    return np.minimum(step, 0xFFFF).astype(np.uint16).tobytes(), step[step >= 0xFFFF].astype(np.uint32).tobytes()


def _decoded(low: bytes, high: bytes) -> np.ndarray:
    step = np.frombuffer(low, np.uint16).astype(np.int64)
    step[step == 0xFFFF] = np.frombuffer(high, np.uint32)
    return np.cumsum(step)


def _dealt(token_sets: TokenSets, bits: int):
    """Texts to tokens by slice, and one row a chunk with what its texts are."""

    def flush(number: int, places: list[np.ndarray], owners: list[np.ndarray], meta: list[pa.RecordBatch], sizes: list[np.ndarray]):
        ids = pa.concat_arrays([m.column("doc_id") for m in meta])
        shas = pa.concat_arrays([m.column("sha") for m in meta])
        # Named by what it holds: if a task is run again and cuts other chunks, counts never go to the wrong texts.
        name = hashlib.sha256(b"".join(shas.to_pylist()) + struct.pack("qq", TaskContext.get().partitionId(), number)).digest()
        chunk = struct.unpack("q", name[:8])[0]
        key = np.sort(np.concatenate(places) << np.uint64(16) | np.concatenate(owners).astype(np.uint64))
        place, owner = key >> np.uint64(16), (key & np.uint64(0xFFFF)).astype(np.uint16)
        new = runs(place)
        several = np.diff(np.append(new, len(place))) > 1
        place, owner = place[new].astype(np.int64), owner[new]
        owner[several] = _SEVERAL
        ends = np.searchsorted(place, np.arange((1 << bits) + 1) << CELL_BITS)
        out = [(chunk % (1 << bits), chunk, None, None, None, ids.to_pylist(), shas.to_pylist(), np.concatenate(sizes).tolist())]
        for k in np.flatnonzero(np.diff(ends)).tolist():
            own = slice(ends[k], ends[k + 1])
            out.append((k, chunk, *_coded(place[own] - (k << CELL_BITS)), owner[own].tobytes(), None, None, None))
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64())]
        names = ["slot", "chunk", "low", "high", "owner", "ids", "shas", "sizes"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, texts = 0, 0, 0
        places, owners, meta, sizes = [], [], [], []
        for piece in pieces(batches, rows=CHUNK_TEXTS):
            if meta and (held >= CHUNK_TOKENS or texts + piece.num_rows > CHUNK_TEXTS):
                yield flush(number, places, owners, meta, sizes)
                number, held, texts = number + 1, 0, 0
                places, owners, meta, sizes = [], [], [], []
            tokens, n = token_sets(*flat(piece.column("text")))
            doc = np.repeat(np.arange(len(n)), n)
            valid = piece.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            low = np.flatnonzero((tokens >> np.uint64(LOOK_BITS) == 0) & valid[doc])
            places.append(tokens[low] >> np.uint64(LOOK_BITS - bits - CELL_BITS))
            owners.append(doc[low] + texts)
            meta.append(piece.select(["doc_id", "sha"]))
            sizes.append(n)
            held, texts = held + len(low), texts + piece.num_rows
        if meta:
            yield flush(number, places, owners, meta, sizes)

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many tokens of each text no other has, by slice and chunk; the chunks' own rows go by."""
    held: dict[int, list[tuple]] = defaultdict(list)
    names = ["chunk", "lone", "ids", "shas", "sizes", "first"]
    for batch in batches:
        meta = batch.column("ids").is_valid()
        for slot, chunk, low, high, owner in zip(*(batch.filter(pc.invert(meta)).column(c).to_pylist() for c in ("slot", "chunk", "low", "high", "owner")), strict=True):
            held[slot].append((chunk, low, high, owner))
        own = batch.filter(meta)
        if own.num_rows:
            yield pa.RecordBatch.from_arrays([own.column("chunk"), pa.nulls(own.num_rows, pa.binary()), *(own.column(c) for c in names[2:])], names)
    while held:
        parts = held.popitem()[1]
        cells = [_decoded(low, high) for _, low, high, _ in parts]
        ends = np.cumsum([len(c) for c in cells])
        owner = np.concatenate([np.frombuffer(p[3], np.uint16) for p in parts])
        key = np.sort(np.concatenate(cells).astype(np.uint64) << np.uint64(32) | np.arange(ends[-1], dtype=np.uint64))
        new = runs(key >> np.uint64(32))
        alone = key[new[np.diff(np.append(new, len(key))) == 1]] & np.uint64(0xFFFFFFFF)
        mine = np.zeros(ends[-1], bool)
        mine[alone.astype(np.int64)] = True
        mine &= owner != _SEVERAL
        chunks, lone = [], []
        for (chunk, *_), stop, cell in zip(parts, ends.tolist(), cells, strict=True):
            at = slice(stop - len(cell), stop)
            if mine[at].any():
                chunks.append(chunk)
                lone.append(zlib.compress(np.bincount(owner[at][mine[at]]).astype(np.uint32).tobytes(), 1))
        rest = [pa.nulls(len(chunks), k) for k in (pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.bool_())]
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(lone, pa.binary()), *rest], names)
    give_back()


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text of the chunks: whether it may link."""
    lone: dict[int, np.ndarray] = {}
    texts = []
    for batch in batches:
        for chunk, packed, *meta in zip(*(batch.column(c).to_pylist() for c in ("chunk", "lone", "ids", "shas", "sizes", "first")), strict=True):
            if packed is None:
                texts.append((chunk, *meta))
                continue
            add = np.frombuffer(zlib.decompress(packed), np.uint32)
            sums = lone.get(chunk, np.zeros(0, np.uint32))
            if len(sums) < len(add):
                sums = np.append(sums, np.zeros(len(add) - len(sums), np.uint32))
            sums[: len(add)] += add
            lone[chunk] = sums
    for chunk, ids, shas, sizes, first in texts:
        n = np.array(sizes, np.int64)
        own = np.zeros(len(n), np.int64)
        sums = lone.pop(chunk, own)
        own[: len(sums)] = sums
        ids = pa.array(ids, pa.int64())
        live = (n > 0) & (own <= n // 4) & ids.is_valid().to_numpy(zero_copy_only=False)
        columns = [ids, pa.array(shas, pa.binary()), pa.array(n), pa.array(live), pa.array(np.full(len(n), first))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "n", "live", "first"])
    give_back()


def judged(distinct: DistinctTexts, token_sets: TokenSets, text_bytes: int) -> DataFrame:
    """doc_id, sha, n, live and first of all distinct texts.

    ``token_sets`` gives the distinct tokens of flat texts, text after text, and how many each has.
    """
    count = slices(text_bytes)
    tasks = count // SLICES_A_TASK
    dealt = distinct.map(_dealt(token_sets, count.bit_length() - 1), _DEALT)
    counts = dealt.repartition(tasks, "slot").mapInArrow(_met, _COUNTS)
    return counts.repartition(tasks, "chunk").mapInArrow(_judged, "doc_id bigint, sha binary, n bigint, live boolean, first boolean")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, to size the filter by."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
