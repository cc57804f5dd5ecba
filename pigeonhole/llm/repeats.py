"""Passages that also start in a document with a smaller id: what word and byte dedup share.

Items are the words or the bytes of a text; a window is ``WINDOW`` consecutive items of one
document. Each window has an anchor, its least hashed run of ``gram`` items, which depends on the
window's content alone; consecutive windows with one anchor form a run. Equal windows
have equal anchors, so only runs whose anchor comes more than once need a closer look.

1. Texts are hashed as wholes. A sketch of these hashes parts the documents that surely have
   no exact copy from the rest; of the rest, the first of each content stays and later ones
   are copies: all their windows repeat.
2. A count-min sketch of anchors (once a document) overestimates how many documents hold a
   window. Documents without an anchor estimated twice are done. The others are written to
   the shared folder.
3. Runs with such an anchor are grouped by content. Later documents of a content lose all its
   windows; its first document stands for it. Only contents whose anchor belongs to several
   contents go on, and a method of the operator's own decides their windows.

Grouping by content uses partial aggregates, and the joins back are plain equi-joins of
written tables, which adaptive execution splits if a content is hot.
"""

from __future__ import annotations

import hashlib
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm import sketch
from pigeonhole.llm.tables import dropped, settled, texts, written
from pigeonhole.llm.text import anchors, flat, mix, pieces, rolling, runs, signed, spanning, starts_within

#: Items of a window.
WINDOW = 50
WHOLE_BITS = 26


class Items(ABC):
    """The items of a piece's texts: ``of_doc`` has where each text's begin, ``lane`` their hashes.

    Shorter anchors (of ``gram`` items) are fewer, but come by chance in more texts.
    """

    gram: int
    of_doc: np.ndarray

    @abstractmethod
    def lane(self, k: int) -> np.ndarray: ...


Split = Callable[[np.ndarray, np.ndarray], Items]
Normal = Callable[[bytes], bytes]


def whole_hashes(column: pa.Array, normal: Normal) -> tuple[np.ndarray, list[bytes]]:
    """SHA-256 of each text in its normal form, and its first half as numbers."""
    data, at = flat(column)
    raw = data.tobytes()
    digests = [hashlib.sha256(normal(raw[a:b])).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 4)[:, 0].copy(), digests


def places(spans: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start of every span: the span it is in, the start and the span's count."""
    starts = spans.field("starts")
    which = np.repeat(np.arange(len(spans)), starts.value_lengths().to_numpy().astype(np.int64))
    count = spans.field("count").to_numpy().astype(np.int64)[which]
    return which, starts.flatten().to_numpy().astype(np.int64), count


class Runs:
    """Runs of windows with one anchor, in all texts of a piece."""

    def __init__(self, items: Items):
        gram = items.gram
        first = items.lane(0)
        at, doc = starts_within(items.of_doc, WINDOW)
        if len(at):
            grams = rolling(first, gram)
            anchor = anchors(grams, WINDOW - gram + 1)[at]
            new = runs(anchor, doc)
            self.anchor = mix(grams[anchor[new]])
            self.doc, self.start = doc[new], at[new]
            self.count = np.diff(np.append(new, len(at)))
        else:
            self.anchor, self.doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.start, self.count = self.doc, self.doc
        self.items = items

    def take(self, kept: np.ndarray) -> None:
        self.anchor, self.doc = self.anchor[kept], self.doc[kept]
        self.start, self.count = self.start[kept], self.count[kept]

    def listed(self, texts: int) -> pa.ListArray:
        """Each text's runs, with one entry for all places of a content, as in texts that repeat a line."""
        items = self.items
        stops = self.start + self.count + WINDOW - 1
        d1, d2 = (spanning(items.lane(k), self.start, stops, k) for k in (0, 1))
        order = np.lexsort((d2, d1, self.doc))
        doc, d1, d2 = self.doc[order], d1[order], d2[order]
        new = runs(doc, d1, d2)
        first = order[new]
        offsets = pa.array(np.append(new, len(order)).astype(np.int32))
        starts = pa.array((self.start - items.of_doc[self.doc]).astype(np.int32)[order])
        fields = [
            pa.array(signed(self.anchor[first])), pa.array(signed(d1[new])), pa.array(signed(d2[new])),
            pa.ListArray.from_arrays(offsets, starts), pa.array(self.count[first].astype(np.int32)),
        ]
        of_text = pa.array(np.searchsorted(doc[new], np.arange(texts + 1)).astype(np.int32))
        return pa.ListArray.from_arrays(of_text, pa.StructArray.from_arrays(fields, ["anchor", "d1", "d2", "starts", "count"]))

    def per_document(self) -> np.ndarray:
        """Anchors, once for each text that has them."""
        order = np.lexsort((self.anchor, self.doc))
        a, d = self.anchor[order], self.doc[order]
        return a[runs(a, d)]


Mapped = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


class DistinctTexts:
    """The distinct texts of a table of doc_id and text, and the documents that may be copies.

    Texts are distinct by their normal form. ``firsts`` has doc_id, text and sha, for each content
    that may occur more than once, of its smallest id; ``maybe`` all documents of such contents.
    All other documents surely have no copy (those without id count as such); they are not
    written, but found again in each pass, in the task that works on them.
    """

    def __init__(self, docs: DataFrame, normal: Normal, limit: int):
        def wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for piece in pieces(batches, limit=limit):
                yield whole_hashes(piece.column("text"), normal)[0]

        twice = docs.sparkSession.sparkContext.broadcast(sketch.build(docs, wholes, WHOLE_BITS, 1))

        def classes(copied: bool) -> Mapped:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for piece in pieces(batches, limit=limit):
                    hashes, digests = whole_hashes(piece.column("text"), normal)
                    ids = piece.column("doc_id")
                    maybe = twice.value.at_least(hashes) & ids.is_valid().to_numpy(zero_copy_only=False)
                    if (maybe == copied).any():
                        mask = pa.array(maybe == copied)
                        digest = pa.array(digests, pa.binary()).filter(mask)
                        yield pa.RecordBatch.from_arrays([ids.filter(mask), piece.column("text").filter(mask), digest], ["doc_id", "text", "sha"])

            return run

        self.docs, self._single = docs, classes(False)
        self.maybe = written(docs.mapInArrow(classes(True), "doc_id bigint, text string, sha binary"), "maybe-copied")
        firsts = self.maybe.groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.min_by("text", "doc_id").alias("text"))
        self.firsts = settled(firsts.select("doc_id", "text", "sha"), "first-texts")

    def map(self, work: Mapped, schema: str, only: Callable[[pa.Array], np.ndarray] | None = None) -> DataFrame:
        """``work`` on batches of doc_id, text and sha of all distinct texts; ``first`` says which kind.

        ``only`` tells by id which texts to take; the others are not even hashed.
        """
        single, inner = self._single, work

        def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch if only is None else batch.filter(pa.array(only(batch.column("doc_id"))))

        alone = self.docs.mapInArrow(lambda batches: inner(single(taken(batches))), schema)
        firsts = self.firsts.mapInArrow(lambda batches: inner(taken(batches)), schema)
        return alone.withColumn("first", F.lit(False)).unionByName(firsts.withColumn("first", F.lit(True)))

    def sketch(self, hashes_of: sketch.Hashes, bits: int, rows: int, thresholds: tuple[int, ...] = (2,)) -> sketch.Sketch:
        single, inner = self._single, hashes_of
        sources = [(self.docs, lambda batches: inner(single(batches))), (self.firsts, hashes_of)]
        return sketch.merged(sources, bits, rows, thresholds)


class Repeats:
    """The steps above over one table of documents."""

    def __init__(self, docs: DataFrame, split: Split, normal: Normal, piece_bytes: int, bits: int, rows: int):
        self.split, self.normal, self.piece_bytes = split, normal, piece_bytes
        self.docs = texts(docs)
        self.context = docs.sparkSession.sparkContext
        self.bits, self.rows = bits, rows

    def prepare(self) -> None:
        split, normal, limit = self.split, self.normal, self.piece_bytes

        distinct = DistinctTexts(self.docs, normal, limit)
        self.maybe = distinct.maybe

        def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for piece in pieces(batches, limit=limit):
                piece = piece.filter(piece.column("doc_id").is_valid())
                if piece.num_rows:
                    yield Runs(split(*flat(piece.column("text")))).per_document()

        self.seen = seen = self.context.broadcast(distinct.sketch(anchors_of, self.bits, self.rows))

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, limit=limit):
                items = split(*flat(piece.column("text")))
                r = Runs(items)
                valid = piece.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                r.take(seen.value.at_least(r.anchor) & valid[r.doc])
                hit = np.bincount(r.doc, minlength=piece.num_rows) > 0
                text = piece.column("text").take(pa.array(np.arange(piece.num_rows), mask=~hit))
                columns = [piece.column("doc_id"), piece.column("sha"), pa.array(np.diff(items.of_doc)), text, r.listed(piece.num_rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "n", "text", "runs"])

        listed = "runs array<struct<anchor:bigint,d1:bigint,d2:bigint,starts:array<int>,count:int>>"
        judged = distinct.map(judge, f"doc_id bigint, sha binary, n bigint, text string, {listed}")
        #: All first documents of their content; text and runs only where windows may repeat. Rows are told
        #: apart by ``row`` and ``doc_id`` together.
        self.judged = settled(judged.withColumn("row", F.xxhash64("doc_id", "sha")), "judged")
        self.touched = self.judged.where("text is not null").select("row", "doc_id", "text")

        found = self.judged.select("row", "doc_id", F.explode("runs").alias("run")).select("row", "doc_id", "run.*")
        groups = found.groupBy("anchor", "d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
        groups = settled(groups, "run-contents")
        several = groups.groupBy("anchor").agg(
            F.count("*").alias("contents"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
        )
        several = several.where("contents > 1 and low < high").select("anchor", "contents")
        several = settled(several, "shared-anchors")
        known = groups.join(several, "anchor", "left").where("last > doc_id or contents is not null")
        known = settled(known.select("d1", "d2", F.col("doc_id").alias("first_id"), "contents"), "known-contents")
        matched = found.join(known, ["d1", "d2"]).where("doc_id > first_id or contents is not null")
        self.matched = matched = settled(matched.select("row", "doc_id", "first_id", "anchor", "starts", "count", "contents"), "matched-runs")
        dropped(groups, several, known)
        #: Whole runs of later documents: row, doc_id, starts, count.
        self.later = matched.where("doc_id > first_id").select("row", "doc_id", "starts", "count")
        #: Runs of first documents of contents whose anchor has several: row, doc_id, anchor, starts, count, contents.
        self.open = matched.where("doc_id = first_id and contents is not null").drop("first_id")

    def filtered(self, rows: DataFrame) -> Callable[[DataFrame, bool], DataFrame]:
        """Parts tables with a column row by whether it may be (true) or surely is not (false) in ``rows``.

        It spares texts the way to a join that they would not take part in.
        """

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for b in batches:
                yield b.column("row").to_numpy().astype(np.uint64)

        some = self.context.broadcast(sketch.build(rows.select("row"), listed, WHOLE_BITS, 1, (1,)))

        def part(df: DataFrame, inside: bool) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    mask = some.value.at_least(b.column("row").to_numpy().astype(np.uint64))
                    if (mask == inside).any():
                        yield b.filter(pa.array(mask == inside))

            return df.mapInArrow(run, df.schema)

        return part

    def finished(self, removed: DataFrame, cut: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], kind: str, *used: DataFrame) -> DataFrame:
        """doc_id, sha, n, n_removed, n_spans, kept (of that kind) and kept_sha of every document.

        ``sha`` is the SHA-256 of a text's normal form; what a document keeps depends on its id and that.
        ``removed`` has row, doc_id, starts and count of the runs of windows that repeat. ``cut`` maps batches
        of doc_id, sha, n, text and spans to the result columns and sha. Tables ``used`` for ``removed`` go once it is written.
        ``kept`` is null where nothing was removed.
        """
        spans = removed.groupBy("row", "doc_id").agg(F.collect_list(F.struct("starts", "count")).alias("spans"))
        spans = settled(spans, "removed-spans")
        dropped(*used)

        rest = self.filtered(spans)
        schema = f"doc_id bigint, sha binary, n bigint, n_removed bigint, n_spans bigint, kept {kind}, kept_sha string"

        def results(judged: DataFrame) -> DataFrame:
            full = judged.where("text is not null").select("doc_id", "sha", "n", "text", "row")
            open_ = rest(full, True).join(spans, ["row", "doc_id"], "left")
            done = open_.select("doc_id", "sha", "n", "text", "spans").mapInArrow(cut, schema)
            narrow = judged.select("doc_id", "sha", "n", "row", F.col("text").isNull().alias("shut"))
            same = narrow.where("not shut").drop("shut")
            shut = narrow.where("shut").drop("shut").unionByName(rest(same, False))
            unchanged = {
                "n_removed": F.lit(0).cast("bigint"), "n_spans": F.lit(0).cast("bigint"),
                "kept": F.lit(None).cast(kind), "kept_sha": F.lower(F.hex("sha")),
            }
            return done.unionByName(shut.drop("row").withColumns(unchanged))

        alone = results(self.judged.where("not first"))
        of_first = settled(results(self.judged.where("first")), "first-results")
        of_first = of_first.withColumnRenamed("doc_id", "first_id")
        both = self.maybe.select("doc_id", "sha").join(of_first, "sha")
        copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n") >= WINDOW)
        # A copy's own windows all repeat; one that is too short for a window keeps everything.
        all_gone = {
            "n_removed": F.col("n"), "n_spans": F.lit(1).cast("bigint"), "kept": F.lit("").cast(kind),
            "kept_sha": F.sha2(F.lit("").cast("binary"), 256),
        }
        both = both.withColumns({c: F.when(copy, v).otherwise(F.col(c)) for c, v in all_gone.items()})
        return alone.unionByName(both.drop("first_id"))
