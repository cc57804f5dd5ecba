"""N-gram Jaccard join over a token-group matrix (operator 6).

A document's tokens are the distinct five-word shingles of its text, lower-cased in A-Z. Two
documents link if their tokens have a Jaccard similarity of 0.75 or more; the result is the
connected component of each document.

1. Texts with equal words are one; its smallest id stands for it.
2. Tokens of one text cannot be shared, so a text with over a quarter of such tokens links with
   none and is done (``shared.judged``). Only of the others are token sets written. A sketch counts in
   how many of these each token comes, never too low; again texts with too many of their own are done.
   The rest order their tokens from rare to common (estimated level, then hash) and keep
   as prefix the part of which linked texts must share one. A full sketch makes prefixes longer, and
   loses no link.
3. Each prefix token has two leaders among its texts, the one of smallest id and the one whose
   tokens are commonest; every text is compared with the leaders it meets. That takes a number of comparisons
   proportional to the prefixes and links nearly all near copies.
4. Texts with the same commonest leader are similar and form a group, in parts of bounded
   size. A part is a sparse matrix of its token union and its members. Where texts of different
   components share a prefix token, one side asks the other's group: it can only link if the
   union holds three quarters of its tokens. Only groups that qualify are opened, and one count
   over the matrix compares the text with all members.

Comparisons within a component are never needed, so copies and near copies are not expanded
into all pairs; no candidate between components is dropped.

Scratch tables and shuffle files go as soon as what comes of them is written.

Defined cases: null and empty texts have no tokens and are their own component; texts of one
to four words have one token, all words; documents without id have no component; rows that
repeat an id are one node; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm import shared, sketch
from pigeonhole.llm.graphs import components
from pigeonhole.llm.repeats import WHOLE_BITS, DistinctTexts
from pigeonhole.llm.tables import cleaned, dropped, settled, texts, written
from pigeonhole.llm.text import LOWER, PIECE_BYTES, Words, binary, flat, pieces, rolling, runs, signed, spanning, starts_within

WORDS = 5
#: Cells of the sketch, as a power of two; counts from which a token is of a commoner level.
SKETCH_BITS, LEVELS = 28, (2, 8, 64)
#: Members of a group, and texts that ask it in one task, on average at most.
GROUP_ROWS, ASKING_ROWS = 256, 1_024
_LOWER_TABLE = bytes(LOWER)


def _plain(raw: bytes) -> bytes:
    return b" ".join(raw.translate(_LOWER_TABLE).split())


def token_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each text, sorted, on end, and how many each has."""
    words = Words(LOWER[data], at)
    hashes = words.hashes()
    start, doc = starts_within(words.of_doc, WORDS)
    tokens = rolling(hashes, WORDS)[start] if len(start) else np.zeros(0, np.uint64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < WORDS))
    if len(short):
        tokens = np.concatenate([tokens, spanning(hashes, words.of_doc[short], words.of_doc[short + 1])])
        doc = np.concatenate([doc, short])
    order = np.lexsort((tokens, doc))
    tokens, doc = tokens[order], doc[order]
    new = runs(tokens, doc)
    return tokens[new], np.bincount(doc[new], minlength=len(at) - 1)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        yield b.column("doc_id").to_numpy().view(np.uint64)


def _among(some: sketch.Sketch, ids: pa.Array) -> np.ndarray:
    """Which ids may be among some; false for null."""
    valid = ids.is_valid().to_numpy(zero_copy_only=False)
    return some.at_least(ids.fill_null(0).to_numpy().view(np.uint64)) & valid


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        tokens, n = token_sets(*flat(piece.column("text")))
        columns = [piece.column("doc_id"), pa.array(n.astype(np.int64)), binary(tokens.view(np.uint8), n * 8)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "tokens"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for piece in pieces(batches, "tokens"):
        yield flat(piece.column("tokens"))[0].view(np.uint64)


def _prefixes(seen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "tokens"):
            data, at = flat(piece.column("tokens"))
            tokens, n = data.view(np.uint64), np.diff(at) // 8
            docs = len(n)
            doc = np.repeat(np.arange(docs), n)
            level = sum(seen.value.at_least(tokens, k).astype(np.int8) for k in range(len(LEVELS)))
            common = np.bincount(doc[level > 0], minlength=docs)
            need = -(-3 * n // 4)
            live = (n > 0) & (common >= need)
            # Rare tokens first; the prefix is what linked texts must share one of.
            order = np.lexsort((tokens, level, doc))
            begin = np.cumsum(n) - n
            place = np.arange(len(tokens)) - begin[doc]
            first = (place < (n - need + 1)[doc]) & (level[order] > 0) & live[doc]
            prefix, per = tokens[order][first], np.bincount(doc[first], minlength=docs)
            offsets = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(prefix)))
            # How common a text's tokens are: largest for the text that its near copies were made from.
            centre = np.bincount(doc, level, minlength=docs) / np.maximum(n, 1)
            columns = [piece.column("doc_id"), piece.column("n"), pa.array(centre), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "centre", "prefix"]).filter(pa.array(live))

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays without repeats share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _numbers(column: pa.Array) -> Iterator[np.ndarray]:
    for v in column:
        yield np.frombuffer(v.as_buffer(), np.uint64)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) of texts whose token sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_numbers(batch.column("x")), _numbers(batch.column("y")), strict=True):
                both = _common(x, y) if 100 * min(len(x), len(y)) >= 75 * max(len(x), len(y)) else 0
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _opened(members: pa.Table, asking: pa.Table) -> pa.Table:
    """Links between a group and the texts that ask it.

    The group is a sparse matrix: its token union, and for each token the members that have it.
    A text opens the group only if the union holds enough of its tokens for a link; then one
    count over the matrix gives its overlap with every member.
    """
    a, b = [], []
    if members.num_rows and asking.num_rows:
        sets = list(_numbers(members.column("tokens").combine_chunks()))
        sizes = np.array([len(x) for x in sets])
        ids = members.column("doc_id").combine_chunks().to_numpy()
        part = members.column("component").combine_chunks().to_numpy()
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        begin = runs(tokens)
        union, per = tokens[begin], np.diff(np.append(begin, len(tokens)))
        own_ids, own_part = asking.column("doc_id").combine_chunks().to_numpy(), asking.column("component").combine_chunks().to_numpy()
        for k, x in enumerate(_numbers(asking.column("tokens").combine_chunks())):
            at = np.minimum(np.searchsorted(union, x), len(union) - 1)
            at = at[union[at] == x]
            if 100 * len(at) < 75 * max(len(x), sizes.min()):
                continue
            take = np.arange(per[at].sum()) - np.repeat(np.cumsum(per[at]) - per[at], per[at]) + np.repeat(begin[at], per[at])
            both = np.bincount(owner[take], minlength=len(sets))
            hit = (100 * both >= 75 * (len(x) + sizes - both)) & (part != own_part[k])
            b += ids[hit].tolist()
            a += [own_ids[k]] * int(hit.sum())
    return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def join(docs: DataFrame, bits: int = SKETCH_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = docs.sparkSession
    docs = texts(docs)
    distinct = DistinctTexts(docs, _plain, PIECE_BYTES)
    copied = written(distinct.maybe.select("doc_id", "sha"), "copied")
    dropped(distinct.maybe)

    every = settled(shared.judged(distinct, token_sets, shared.text_bytes(docs)), "judged-texts")
    live = spark.sparkContext.broadcast(sketch.build(every.where("live").select("doc_id"), _ids, WHOLE_BITS, 1, (1,)))
    sets = distinct.map(_sets, "doc_id bigint, n bigint, tokens binary", lambda ids: _among(live.value, ids))
    sets = settled(sets.drop("first"), "token-sets")
    dropped(distinct.firsts)
    with cleaned(spark):
        seen = spark.sparkContext.broadcast(sketch.build(sets.select("tokens"), _listed, bits, 1, LEVELS))
    prefix = sets.mapInArrow(_prefixes(seen), "doc_id bigint, n bigint, centre double, prefix array<bigint>")
    prefix = settled(prefix.select("doc_id", "n", "centre", F.explode("prefix").alias("token")), "prefixes")

    # Every text against the leaders of its prefix tokens.
    text = F.struct("doc_id", "n", "centre")
    central = F.max_by(text, F.struct("centre", "doc_id"))
    leaders = prefix.groupBy("token").agg(F.min(text).alias("l1"), central.alias("l2"), F.max("doc_id").alias("last"))
    leaders = settled(leaders.where("l1.doc_id < last").select("token", F.array("l1", "l2").alias("leaders")), "leaders")
    met = prefix.join(leaders, "token").select("doc_id", "n", F.explode("leaders").alias("leader"))
    near = F.least("n", "leader.n") * 100 >= F.greatest("n", "leader.n") * 75
    met = met.where(near & (F.col("doc_id") != F.col("leader.doc_id")))
    pairs = met.select(F.least("doc_id", "leader.doc_id").alias("a"), F.greatest("doc_id", "leader.doc_id").alias("b")).distinct()
    pairs = settled(pairs, "leader-pairs")
    links = settled(linked(pairs, sets), "leader-links")
    dropped(pairs)
    part = components(links)

    # Groups of similar texts: those whose commonest leader is the same, in bounded parts.
    home = F.max_by("leader.doc_id", F.struct("leader.centre", "leader.doc_id")).alias("home")
    kin = prefix.join(leaders, "token").select("doc_id", F.element_at("leaders", 2).alias("leader")).groupBy("doc_id").agg(home)
    kin = kin.join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    kin = settled(kin.select("doc_id", "home", F.coalesce("component", "doc_id").alias("component")), "homes")
    dropped(part)
    sizes = kin.groupBy("component").agg(F.count("*").alias("size"))
    tokens = prefix.select("token", "doc_id").join(leaders.select("token"), "token").join(kin, "doc_id").join(sizes, "component")
    tokens = settled(tokens, "placed-prefixes")
    dropped(prefix, leaders)
    # Only where components meet at a token. The texts of the largest one there need not ask.
    largest = F.max_by("component", F.struct("size", "component"))
    open_ = tokens.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), largest.alias("largest"))
    open_ = settled(open_.where("low < high").select("token", "largest"), "open-tokens")
    near = tokens.join(open_, "token")
    asking = near.where("component <> largest").select("token", "doc_id", F.col("home").alias("own"))
    asked = near.groupBy("token", "home").agg(F.bool_or(F.col("component") == F.col("largest")).alias("silent"))
    # Of two groups the one of smaller id asks, unless its texts are among the silent ones.
    asks = asking.join(asked, "token").where("silent or home >= own").select("doc_id", "home").distinct()
    asks = settled(asks, "asked-groups")
    dropped(tokens, open_)
    parts = kin.groupBy("home").agg(F.ceil(F.count("*") / group_rows).cast("int").alias("salts"))
    turns = asks.groupBy("home").agg(F.ceil(F.count("*") / ASKING_ROWS).cast("int").alias("turns"))
    parts = settled(parts.join(turns, "home"), "group-parts")
    mine, turn = (F.pmod(F.xxhash64("doc_id"), F.col(c)).cast("int") for c in ("salts", "turns"))
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    whole = kin.select("doc_id", "home", "component").join(parts, "home").withColumn("salt", mine).withColumn("turn", each("turns"))
    whole = whole.select("doc_id", "component", "home", "salt", "turn").join(sets.select("doc_id", "tokens"), "doc_id")
    texts_ = asks.join(parts, "home").withColumn("turn", turn).withColumn("salt", each("salts")).join(kin.select("doc_id", "component"), "doc_id")
    texts_ = texts_.select("doc_id", "component", "home", "salt", "turn").join(sets.select("doc_id", "tokens"), "doc_id")
    texts_ = texts_.select([F.col(c).alias(c) for c in texts_.columns])  # columns of its own, as both sides come from one table
    by = ["home", "salt", "turn"]
    more = whole.groupBy(by).cogroup(texts_.groupBy(by)).applyInArrow(_opened, "a bigint, b bigint")
    more = settled(more, "group-links")
    dropped(sets, kin, asks, parts)
    part = components(links.unionByName(more))
    dropped(links, more)

    result = every.drop("live").join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    result = result.select("doc_id", "sha", "first", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    alone = result.where("not first").drop("sha", "first")
    of_first = settled(result.where("first").select("sha", "n_shingles", "component_id"), "first-components")
    copies = copied.join(of_first, "sha").select("doc_id", "n_shingles", "component_id")
    itself = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return alone.unionByName(copies.withColumn("component_id", itself))
