"""Substring dedup: words covered by windows that also start in an earlier document (operator 3).

A count-min sketch is built a partition at a time and merged (``sketch``). Its key for a window
of 50 words is the window's anchor, which equal windows share, counted once a document; so the
count of a window's cell is never below the number of documents that hold the window. A second
pass takes only windows estimated repeated and groups them exactly, by 128-bit hashes of their
words: first whole runs of windows, then, where one anchor has several run contents, single
windows. See ``repeats`` for the steps.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Defined cases: null and empty texts have no words;
documents without id keep everything and repeat nothing; rows that repeat an id are equal in
rank, so none removes words of another; documents of fewer than 50 words keep everything;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pigeonhole.llm.repeats import WINDOW, Items, Repeats, places, whole_hashes
from pigeonhole.llm.tables import settled, ship
from pigeonhole.llm.text import PIECE_BYTES, Words, flat, pieces, rolling, signed

#: Cells of each row of the sketch, as a power of two, and its rows.
SKETCH_BITS, SKETCH_ROWS = 27, 2


class WordItems(Items):
    gram = 10

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.words = Words(data, at)
        self.of_doc = self.words.of_doc
        self._lanes: dict[int, np.ndarray] = {}

    def lane(self, k: int) -> np.ndarray:
        if k not in self._lanes:
            self._lanes[k] = self.words.hashes(k)
        return self._lanes[k]


def one_space(raw: bytes) -> bytes:
    """Words joined by one space; bytes.split() parts at just the blanks that are no word bytes."""
    return b" ".join(raw.split())


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of the given runs of each text."""
    for piece in pieces(batches):
        items = WordItems(*flat(piece.column("text")))
        spans = piece.column("spans")
        doc = np.repeat(np.arange(piece.num_rows), np.diff(spans.offsets.to_numpy()))
        which, start, count = places(spans.flatten())
        doc = doc[which]
        owner = np.repeat(doc, count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
        at, own = place + items.of_doc[owner], pa.array(owner)
        columns = [
            piece.column("row").take(own), piece.column("doc_id").take(own), pa.array(place.astype(np.int32)),
            *(pa.array(signed(rolling(items.lane(k), WINDOW, k)[at])) for k in (0, 1)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "start", "w1", "w2"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        texts, spans = piece.column("text").to_pylist(), piece.column("spans")
        removed, spans_, kept, shas = [], [], [], []
        for k, text in enumerate(texts):
            words = text.encode().split()
            own = spans[k].values
            if own is None or len(own) == 0:
                gone, cuts, left = 0, 0, words
            else:
                _, start, count = places(own)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + count + WINDOW - 1, -1)
                stays = np.cumsum(edge[:-1]) == 0
                left = [words[i] for i in np.flatnonzero(stays)]
                gone, cuts = len(words) - len(left), int((np.diff(stays.astype(np.int8), prepend=1) == -1).sum())
            whole = b" ".join(left)
            removed.append(gone)
            spans_.append(cuts)
            kept.append(whole.decode() if gone else None)
            shas.append(hashlib.sha256(whole).hexdigest())
        made = [pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()), pa.array(kept, pa.string()), pa.array(shas, pa.string())]
        columns = [*(piece.column(c) for c in ("doc_id", "sha", "n")), *made]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "n", "n_removed", "n_spans", "kept", "kept_sha"])


def with_sha(docs: DataFrame, name: str) -> DataFrame:
    """The rows with one more column, the ``sha`` that dedup gives for their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            digests = pa.array(whole_hashes(piece.column("text"), one_space)[1], pa.binary())
            yield pa.RecordBatch.from_arrays([*piece.columns, digests], [*piece.schema.names, name])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(name, T.BinaryType())]))


def dedup(docs: DataFrame, bits: int = SKETCH_BITS, rows: int = SKETCH_ROWS) -> DataFrame:
    """doc_id, sha, n, n_removed, n_spans, kept and kept_sha of every document.

    ``kept`` has the kept words joined by one space, and is null where nothing was removed.
    """
    r = Repeats(docs, WordItems, one_space, PIECE_BYTES, bits, rows)
    r.prepare()
    spans = r.open.groupBy("row", "doc_id").agg(F.collect_list(F.struct("starts", "count")).alias("spans"))
    spans = settled(spans, "open-spans")
    rows_ = r.filtered(spans)(r.touched, True).join(spans, ["row", "doc_id"]).select("row", "doc_id", "text", "spans")
    windows = settled(rows_.mapInArrow(_windows, "row bigint, doc_id bigint, start int, w1 bigint, w2 bigint"), "windows")
    seen = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last"))
    seen = settled(seen.where("last > first_id").drop("last"), "repeated-windows")
    single = windows.join(seen, ["w1", "w2"]).where("doc_id > first_id").select("row", "doc_id", F.array("start").alias("starts"), F.lit(1).alias("count"))
    return r.finished(r.later.unionByName(single), _cut, "string", r.matched, spans, windows, seen)
