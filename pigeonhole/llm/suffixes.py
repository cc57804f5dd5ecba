"""Byte dedup with run-length compressed Burrows-Wheeler indexes (operator 9).

Bytes covered by a 50-byte string that also starts in a document with a smaller id go. The
steps in ``repeats`` leave contents whose anchor occurs with several contents. Each is a segment
of at most 80 bytes, indexed once a document however many places it has there, and dealt into
a bucket by its anchor.

A bucket's segments on end are indexed by the runs of their Burrows-Wheeler transform: for each
run its symbol, where its first row maps to, and the text positions of its first and last row.
Blocks of rows that share 50 bytes have their least document. Nothing is kept a row. All segments are
then streamed from their ends at the same time for their matching statistics: where the row's run has
the wanted symbol the match grows by one; where not, it goes on from the end of the nearest run of that symbol,
above or below, whichever agrees longer, as told from the sampled positions. A match of 50 bytes
or more is marked if the documents of its block, or the one at its position, have a smaller id.
What a content loses, it loses at all its places.

A bucket takes about 1 MB, and an anchor with over 10,000 contents (0.8 MB) does not go into one: its
windows are grouped by 128-bit hashes with partial aggregates and a join, which gives the same answer and
can be split.

Defined cases: null texts are empty; documents without id keep everything and repeat nothing;
rows that repeat an id remove nothing of each other; texts below 50 bytes keep everything;
empty tables give no rows; other columns are ignored. ``kept`` is binary, as a cut may fall
within a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.repeats import WINDOW, Items, Repeats, places
from pigeonhole.llm.tables import settled
from pigeonhole.llm.text import binary, flat, mix, pieces, rolling, runs, signed

SKETCH_BITS, SKETCH_ROWS = 28, 2
PIECE_BYTES = 1 << 20
#: Bytes of a bucket, on average, and contents of an anchor, of 80 bytes at most, up to which it goes into one.
BUCKET_BYTES, MOST_CONTENTS = 1 << 20, 10_000

_VALUES = [mix(np.arange(256, dtype=np.uint64) + np.uint64((k + 7) << 32)) for k in (0, 1)]


class ByteItems(Items):
    gram = 20

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.of_doc = data, at

    def lane(self, k: int) -> np.ndarray:
        return _VALUES[k][self.data]


def _sorted_suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffix array of a text that ends in its only least symbol, and ranks by the first ``depth`` symbols.

    Prefix doubling from as many symbols as fit into 63 bits. ``depth`` is at most ``WINDOW`` and
    at least half of it. Later rounds sort only suffixes that are still equal.
    """
    n = len(text)
    values = np.unique(text)
    dense = np.zeros(int(values[-1]) + 1, np.int64)
    dense[values] = np.arange(len(values))
    bits = max(int(len(values) - 1).bit_length(), 1)
    depth = min(63 // bits, WINDOW)
    padded = np.concatenate([dense[text], np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key = (key << bits) | padded[k : n + k]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    place = np.arange(n)
    # A suffix's rank is the first place of its group.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    kept = None
    while True:
        if depth <= WINDOW <= 2 * depth:
            kept, kept_depth = rank.copy(), depth
        at = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(at):
            break
        suffix = order[at]
        behind = suffix + depth
        behind = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        key = rank[suffix] * (n + 1) + behind
        local = np.argsort(key)
        key = key[local]
        order[at] = suffix[local]
        new[at[0]] = True
        new[at[1:]] = key[1:] != key[:-1]
        rank[order[at]] = np.maximum.accumulate(np.where(new, place, 0))[at]
        depth *= 2
    # With all suffixes apart early, ranks tell any number of symbols apart.
    return (order, rank, WINDOW) if kept is None else (order, kept, kept_depth)


class RunIndex:
    """Runs of the transform with sampled ends, and blocks of rows that share ``WINDOW`` bytes."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, docs: np.ndarray):
        segments = len(lengths)
        self.ends = ends = np.cumsum(lengths + 1) - 1
        self.docs = docs
        text = np.ones(ends[-1] + 2, np.int16)
        inside = np.ones(len(text), bool)
        inside[ends], inside[-1] = False, False
        text[inside] = data.astype(np.int16) + 2
        text[-1] = 0
        n = len(text)
        order, rank, depth = _sorted_suffixes(text)
        last = text[order - 1]
        starts = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
        self.run_starts, self.run_lasts = starts.astype(np.int32), (np.append(starts[1:], n) - 1).astype(np.int32)
        self.heads = heads = last[starts].astype(np.int64)
        # Where a run's first row maps to: symbols below, and the same symbol in runs before.
        by_symbol = np.argsort(heads, kind="stable")
        sizes = (self.run_lasts - self.run_starts + 1)[by_symbol]
        self.maps_to = np.empty(len(heads), np.int32)
        self.maps_to[by_symbol] = np.cumsum(sizes) - sizes
        self.first_at, self.last_at = order[self.run_starts], order[self.run_lasts]
        # Runs by symbol and place, to find the nearest of a symbol.
        self.by_symbol, self.symbol_keys = by_symbol, heads[by_symbol] * len(heads) + by_symbol
        # Four symbols in a number, to compare positions.
        padded = np.concatenate([text, np.zeros(4, np.int16)]).astype(np.uint64)
        self.fours = padded[:n] | padded[1 : n + 1] << np.uint64(16) | padded[2 : n + 2] << np.uint64(32) | padded[3 : n + 3] << np.uint64(48)
        # Rows of strings of WINDOW bytes within a segment, in blocks of equal ones.
        owner = np.repeat(np.arange(segments + 1), np.append(lengths + 1, 1))
        room = np.append(ends, n)[owner] - np.arange(n)
        usable = room[order] >= WINDOW
        tail = rank[np.minimum(order + (WINDOW - depth), n - 1)]
        head = rank[order]
        same = (head[1:] == head[:-1]) & (tail[1:] == tail[:-1]) & usable[1:] & usable[:-1]
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        several = np.diff(np.append(starts, n)) > 1
        least = np.minimum.reduceat(np.append(docs, np.iinfo(np.int64).max)[owner[order]], starts)
        self.block_starts, self.block_ends = starts[several], np.append(starts[1:], n)[several]
        self.block_least = least[several]

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols from two positions on agree, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        live, n = np.arange(len(a)), len(self.fours)
        for done in range(0, int(most.max(initial=0)), 4):
            x = self.fours[np.minimum(a[live] + done, n - 1)] ^ self.fours[np.minimum(b[live] + done, n - 1)]
            low = x & (~x + np.uint64(1))
            out[live] += np.where(x == 0, 4, (low > np.uint64(0xFFFF)).astype(np.int64) + (low > np.uint64(0xFFFFFFFF)) + (low > np.uint64(0xFFFFFFFFFFFF)))
            live = live[(x == 0) & (out[live] < most[live])]
            if not len(live):
                break
        return np.minimum(out, most)

    def extend(self, rows: np.ndarray, at: np.ndarray, match: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows, positions and lengths (up to ``WINDOW``) of the longest matches of strings one symbol longer in front."""
        run = np.searchsorted(self.run_starts, rows, "right") - 1
        within = rows - self.run_starts[run]
        at, match = at.copy(), match.copy()
        other = np.flatnonzero(self.heads[run] != symbols)
        if len(other):
            symbol, count, old = symbols[other], len(self.heads), at[other]
            key = np.searchsorted(self.symbol_keys, symbol * count + run[other])
            below, above = self.by_symbol[np.minimum(key, count - 1)], self.by_symbol[np.maximum(key - 1, 0)]
            is_below = (self.heads[below] == symbol) & (key < count)
            is_above = (self.heads[above] == symbol) & (key > 0)
            longest = np.where(is_below | is_above, match[other], 0)
            with_below = np.where(is_below, self._agree(old, self.first_at[below], longest), -1)
            with_above = np.where(is_above, self._agree(old, self.last_at[above], longest), -1)
            up = with_above > with_below
            nearest = np.where(up, above, below)
            within[other] = np.where(up, self.run_lasts[above] - self.run_starts[above], 0)
            at[other] = np.where(up, self.last_at[above], self.first_at[below])
            match[other] = np.maximum(with_above, with_below)
            run[other] = nearest
        # A symbol that the index lacks matches nothing: -1 becomes 0, and any row will do.
        return self.maps_to[run] + within, np.maximum(at - 1, 0), np.minimum(match + 1, WINDOW)

    def least_document(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The least document that holds the matched window."""
        least = self.docs[np.minimum(np.searchsorted(self.ends, at), len(self.docs) - 1)]
        if len(self.block_starts):
            block = np.maximum(np.searchsorted(self.block_starts, rows, "right") - 1, 0)
            inside = (rows >= self.block_starts[block]) & (rows < self.block_ends[block])
            least = np.where(inside, self.block_least[block], least)
        return least


def streamed(index: RunIndex, data: np.ndarray, lengths: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each byte of any segments: whether ``WINDOW`` bytes from here match in a smaller document of the index."""
    out = np.zeros(len(data), bool)
    after = np.cumsum(lengths)
    order = np.argsort(-lengths, kind="stable")
    sizes, after = lengths[order], after[order]
    rows, at, match = (np.zeros(len(order), np.int64) for _ in range(3))
    for back in range(1, int(lengths.max(initial=0)) + 1):
        live = int(np.searchsorted(-sizes, -back, "right"))
        place = after[:live] - back
        rows, at, match = index.extend(rows[:live], at[:live], match[:live], data[place].astype(np.int64) + 2)
        full = np.flatnonzero(match >= WINDOW)
        if len(full):
            out[place[full]] = index.least_document(rows[full], at[full]) < docs[order[full]]
    return out


def earlier(data: np.ndarray, lengths: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each byte of the segments: whether ``WINDOW`` bytes from here start in a smaller document."""
    return streamed(RunIndex(data, lengths, docs), data, lengths, docs)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the given runs of each text, once for all places."""
    for piece in pieces(batches, limit=PIECE_BYTES):
        data, at = flat(piece.column("text"))
        spans = piece.column("spans")
        doc = np.repeat(np.arange(piece.num_rows), np.diff(spans.offsets.to_numpy()))
        inner = spans.flatten()
        starts, count = inner.field("starts"), inner.field("count").to_numpy().astype(np.int64)
        start = starts.flatten().to_numpy()[np.cumsum(starts.value_lengths().to_numpy()) - 1].astype(np.int64)
        size = count + WINDOW - 1
        begin = np.cumsum(size) - size
        take = np.arange(size.sum()) + np.repeat(start + at[doc] - begin, size)
        own = pa.array(doc)
        columns = [piece.column("row").take(own), piece.column("doc_id").take(own), *(inner.field(c) for c in ("anchor", "contents", "starts"))]
        yield pa.RecordBatch.from_arrays([*columns, binary(data[take], size)], ["row", "doc_id", "anchor", "contents", "starts", "bytes"])


REMOVED = "row bigint, doc_id bigint, starts array<int>, count int"


def _shifted(starts: pa.ListArray, which: np.ndarray, by: np.ndarray) -> pa.ListArray:
    """The lists taken, each with a number added to all its values."""
    taken = starts.take(pa.array(which))
    sizes = taken.value_lengths().to_numpy()
    values = taken.flatten().to_numpy() + np.repeat(by, sizes)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values.astype(np.int32)))


def _bucket(table: pa.Table) -> pa.Table:
    """Runs of windows of a bucket's segments that start in a smaller document."""
    data, at = flat(table.column("bytes"))
    lengths, docs = np.diff(at), table.column("doc_id").combine_chunks().to_numpy()
    found = earlier(data, lengths, docs)
    hit = np.flatnonzero(found)
    owner = np.searchsorted(at, hit, "right") - 1
    new = runs(owner, hit - np.arange(len(hit)))
    count = np.diff(np.append(new, len(hit)))
    own = owner[new]
    row, starts = (table.column(c).combine_chunks() for c in ("row", "starts"))
    columns = [row.take(pa.array(own)), pa.array(docs[own]), _shifted(starts, own, hit[new] - at[own]), pa.array(count.astype(np.int32))]
    return pa.Table.from_arrays(columns, ["row", "doc_id", "starts", "count"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the segments, as hashes."""
    for piece in pieces(batches, "bytes", PIECE_BYTES):
        items = ByteItems(*flat(piece.column("bytes")))
        room = np.diff(items.of_doc) - WINDOW + 1
        owner = np.repeat(np.arange(len(room)), room)
        place = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        at, own = place + items.of_doc[owner], pa.array(owner)
        columns = [piece.column("row").take(own), piece.column("doc_id").take(own), _shifted(piece.column("starts"), owner, place)]
        columns += [pa.array(signed(rolling(items.lane(k), WINDOW, k)[at])) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "starts", "w1", "w2"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        data, at = flat(piece.column("text"))
        spans = piece.column("spans")
        removed, cuts, kept, shas = [], [], [], []
        for k in range(piece.num_rows):
            own, part = spans[k].values, data[at[k] : at[k + 1]]
            edge = np.zeros(len(part) + 1, np.int64)
            if own is not None and len(own):
                _, start, count = places(own)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + count + WINDOW - 1, -1)
            stays = np.cumsum(edge[:-1]) == 0
            raw = part[stays].tobytes()
            removed.append(len(part) - len(raw))
            cuts.append(int((np.diff(stays.astype(np.int8), prepend=1) == -1).sum()))
            kept.append(raw if removed[-1] else None)
            shas.append(hashlib.sha256(raw).hexdigest())
        made = [pa.array(removed, pa.int64()), pa.array(cuts, pa.int64()), pa.array(kept, pa.binary()), pa.array(shas, pa.string())]
        columns = [*(piece.column(c) for c in ("doc_id", "sha", "n")), *made]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "n", "n_removed", "n_spans", "kept", "kept_sha"])


def dedup(docs: DataFrame, bits: int = SKETCH_BITS, rows: int = SKETCH_ROWS, most_contents: int = MOST_CONTENTS) -> DataFrame:
    """doc_id, sha, n, n_removed, n_spans, kept and kept_sha of every document.

    ``kept`` has the remaining bytes, and is null where nothing was removed.
    """
    r = Repeats(docs, ByteItems, bytes, PIECE_BYTES, bits, rows)
    r.prepare()
    spans = r.open.groupBy("row", "doc_id").agg(F.collect_list(F.struct("starts", "count", "anchor", "contents")).alias("spans"))
    spans = settled(spans, "open-spans")
    texts = r.filtered(spans)(r.touched, True).join(spans, ["row", "doc_id"]).select("row", "doc_id", "text", "spans")
    schema = "row bigint, doc_id bigint, anchor bigint, contents bigint, starts array<int>, bytes binary"
    segments = texts.mapInArrow(_segments, schema)
    segments = settled(segments.withColumn("size", F.length("bytes")), "segments")
    small, large = segments.where(F.col("contents") <= most_contents), segments.where(F.col("contents") > most_contents)
    total = small.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // BUCKET_BYTES)))).cast("int")
    small = small.select("row", "doc_id", "starts", "bytes", bucket.alias("bucket"))
    found = small.groupBy("bucket").applyInArrow(_bucket, REMOVED)
    windows = large.select("row", "doc_id", "starts", "bytes").mapInArrow(_hashed, "row bigint, doc_id bigint, starts array<int>, w1 bigint, w2 bigint")
    seen = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last"))
    seen = settled(seen.where("last > first_id").drop("last"), "repeated-windows")
    single = windows.join(seen, ["w1", "w2"]).where("doc_id > first_id").select("row", "doc_id", "starts", F.lit(1).alias("count"))
    return r.finished(r.later.unionByName(found).unionByName(single), _cut, "binary")
