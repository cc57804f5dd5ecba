"""Toxicity: boosted trees over dense features, with isotonic calibration (operator 5).

The lexicon is learned: from a bounded sample of labelled rows, words and four-character word
beginnings that are far commoner in toxic texts, beside a short list of common insults. Entries fall into tiers by the share of toxic
texts that have them. Features of a text are the densities and counts of each tier, how near
entries stand to second-person words, and rates of capitals, punctuation, symbols and masked
letters. The sample is dealt into three parts; each part's features use the lexicon of the
others, so that the trees see entries as they will act on new texts. Two of three rows train
the trees, the third calibrates.

The driver gets the features of the sample (a bounded number of rows) and a bounded lexicon.

Defined cases: null and empty texts are scored as texts without words; without labels every
text gets the same score; equal rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm import trees
from pigeonhole.llm.features import SECOND, Terms, dense, hash_words, per_doc
from pigeonhole.llm.samples import SAMPLE_ROWS, labelled
from pigeonhole.llm.tables import texts, written
from pigeonhole.llm.text import Words, flat, pieces, rolling, runs, signed, starts_within

PARTS = 3
#: Insults that are entries whatever the sample shows (fixed values).
BASE = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "garbage", "pathetic", "worthless",
        "disgusting", "clown", "fool", "imbecile", "jerk", "crap", "bastard", "bitch", "asshole", "shit", "fuck", "fucking")
#: Entries of a lexicon at most; the strongest stay.
ENTRIES = 4_000
#: Share of toxic texts that have an entry, from which it is in the first, second, third tier.
TIERS = (0.05, 0.01, 0.0)
MOST_CHARS = 24


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted hashes
    tier: np.ndarray
    weight: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash among the entries, -1 if it is none."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def _tokens(t: Terms) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the beginnings (of words of four characters or more) and of whole words."""
    doc = np.repeat(np.arange(len(t.of_doc) - 1), np.diff(t.of_doc))
    a, b = t.chars >= 4, t.chars <= MOST_CHARS
    return np.concatenate([t.head[a], t.whole[b]]), np.concatenate([doc[a], doc[b]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        h, d = _tokens(Terms(*flat(piece.column("text"))))
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = runs(h, d)
        h, d = h[new], d[new]
        columns = [pa.array(signed(h)), *(piece.column(c).take(pa.array(d)) for c in ("kin", "part", "y"))]
        yield pa.RecordBatch.from_arrays(columns, ["h", "kin", "part", "y"])


def _kin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least hash of a text's word triples, which near copies mostly share."""
    for piece in pieces(batches):
        words = Words(*flat(piece.column("text")))
        at, doc = starts_within(words.of_doc, 3)
        least = np.full(piece.num_rows, np.uint64(2**64 - 1))
        np.minimum.at(least, doc, rolling(words.hashes(), 3)[at])
        columns = [piece.column(c) for c in ("doc_id", "text", "y")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(signed(least))], ["doc_id", "text", "y", "kin"])


def _lexicon(counts: DataFrame, toxic: int, clean: int) -> Lexicon:
    """The entries of summed counts (h, t, c) that stand for toxic texts."""
    base = hash_words(BASE)
    if not toxic:
        return Lexicon(np.sort(base), np.zeros(len(base), int), np.full(len(base), 3.0))
    weight = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(clean + 1.0))
    strong = counts.where("t >= 3").withColumn("w", weight).where("w > 2")
    rows = strong.orderBy(F.desc(F.col("t") * F.col("w")), "h").limit(ENTRIES).collect()
    keys = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    share = np.array([r["t"] / toxic for r in rows])
    fresh = ~np.isin(keys, base)
    keys = np.concatenate([base, keys[fresh]])
    tier = np.concatenate([np.zeros(len(base), int), sum((share < t).astype(int) for t in TIERS[:-1])[fresh]])
    weight = np.concatenate([np.full(len(base), 3.0), np.array([r["w"] for r in rows])[fresh]])
    order = np.argsort(keys)
    return Lexicon(keys[order], tier[order], weight[order])


_SECOND = np.sort(hash_words(SECOND))


def features(data: np.ndarray, at: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    t = Terms(data, at)
    docs = len(at) - 1
    n = np.diff(t.of_doc)
    doc = np.repeat(np.arange(docs), n)
    each = np.maximum(n, 1).astype(float)
    head, whole = lexicon.find(t.head), lexicon.find(t.whole)
    head[t.chars < 4], whole[t.chars > MOST_CHARS] = -1, -1
    hit = np.where(head >= 0, head, whole)
    columns = []
    for k in range(len(TIERS)):
        count = per_doc((hit >= 0) & (lexicon.tier[hit] == k) if len(lexicon.keys) else hit >= 0, t.of_doc)
        columns += [np.minimum(count, 20), count / each]
    value = np.where(hit >= 0, lexicon.weight[hit], 0.0) if len(lexicon.keys) else np.zeros(len(hit))
    columns.append(per_doc(value, t.of_doc) / each)
    found = np.minimum(np.searchsorted(_SECOND, t.whole), len(_SECOND) - 1)
    second = np.flatnonzero(_SECOND[found] == t.whole)
    near = np.zeros(len(hit), bool)
    hits = np.flatnonzero(hit >= 0)
    if len(second) and len(hits):
        k = np.searchsorted(second, hits)
        for side in (np.minimum(k, len(second) - 1), np.maximum(k - 1, 0)):
            near[hits] |= (np.abs(second[side] - hits) <= 5) & (doc[second[side]] == doc[hits])
    columns += [per_doc(near, t.of_doc) / each, np.bincount(doc[second], minlength=docs) / each, per_doc(t.masked, t.of_doc) / each]
    general = dense(data, at)
    # size, capitals, punctuation, symbols, exclamation marks, other bytes, symbols at word ends, repetition
    return np.concatenate([np.stack(columns, 1), general[:, [1, 4, 6, 7, 8, 9, 11, 15, 17]]], 1)


@dataclass
class Model:
    lexicon: Lexicon
    forest: trees.Forest
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        raw = self.forest.raw(features(data, at, self.lexicon))
        # A little of the raw score keeps the order within flat stretches of the calibration.
        return np.clip(np.interp(raw, *self.knots) * 0.99 + 0.01 * trees.sigmoid(raw), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the labelled documents for which ``usable`` (over doc_id) holds."""
    sample = labelled(docs, labels, "toxic", usable, rows).select("doc_id", "text", "y")
    sample = sample.mapInArrow(_kin, "doc_id bigint, text string, y int, kin bigint")
    sample = written(sample.withColumn("part", F.pmod(F.xxhash64("kin"), F.lit(PARTS)).cast("int")), "toxic-sample")
    kinds = sample.select("kin", "part", "y").distinct()
    of = {(r["part"], r["y"]): r["n"] for r in kinds.groupBy("part", "y").agg(F.count("*").alias("n")).collect()}
    # Near copies count once: an entry's support is the number of kinds of texts that have it.
    counts = sample.mapInArrow(_count, "h bigint, kin bigint, part int, y int").distinct().groupBy("h", "part")
    counts = written(counts.agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")), "toxic-terms")
    lexicons = []
    for part in range(PARTS + 1):  # the last one is of all parts
        kept = [p for p in range(PARTS) if p != part]
        summed = counts.where(F.col("part") != part).groupBy("h").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        lexicons.append(_lexicon(summed, sum(of.get((p, 1), 0) for p in kept), sum(of.get((p, 0), 0) for p in kept)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            part = piece.column("part").to_numpy()
            for p in np.unique(part):
                own = piece.filter(pa.array(part == p))
                x = features(*flat(own.column("text")), lexicons[p])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), lists, own.column("y")], ["doc_id", "x", "y"])

    found = sample.mapInArrow(run, "doc_id bigint, x array<double>, y int").orderBy("doc_id", "y", "x").collect()
    width = features(np.zeros(0, np.uint8), np.zeros(1, np.int64), lexicons[-1]).shape[1]
    x, y = np.array([r["x"] for r in found]).reshape(-1, width), np.array([r["y"] for r in found], float)
    held = np.arange(len(y)) % 3 == 2
    forest = trees.fit(x[~held], y[~held])
    knots = trees.isotonic(forest.raw(x[held]), y[held]) if held.any() else (np.array([0.0]), np.array([0.5]))
    return Model(lexicons[-1], forest, knots)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: more likely toxic) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            s = model.score(*flat(piece.column("text")))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id bigint, score double")
