"""Language identification by the nearest of several centroids per language (operator 7).

A text is the vector of its letter trigrams (bytes, lower case, whatever is no letter as one
blank), hashed into ``CELLS`` cells, with square-root counts, weighted by inverse document
frequency over all training documents and normalised. Centroids are found by spherical k-means
within each language on a bounded sample of training documents; the vectors of that sample and
the centroids are all the driver sees. A text gets the language of the centroid with the
largest cosine, and is rejected as ``und`` if that is further away than ``furthest`` allows; the
default of 1.0, which the query has, rejects none.

Defined cases: null text, empty text and text without a letter are ``und`` with score 0;
without any training document every text is ``und``; ties go to the first language by name;
equal rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pigeonhole.llm.tables import ship
from pigeonhole.llm.text import LOWER, flat, pieces

CELLS = 4096
#: Training documents whose vectors are clustered: a language's and all languages' at most.
LANGUAGE_ROWS, SAMPLE_ROWS = 1_000, 6_000
#: Shares of a language's rows that are picked from apart.
SHARES = 64
CENTROIDS, SWEEPS = 4, 10
PIECE_ROWS = 1_500
UNKNOWN = "und"

_SIMPLE = LOWER.copy()
for _b in range(128):
    if not 97 <= _SIMPLE[_b] < 123:
        _SIMPLE[_b] = 32


def counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How often each cell's trigrams occur in each text, as rows."""
    docs = len(at) - 1
    # Two blanks before each text and one behind keep trigrams within texts.
    lengths = np.diff(at) + 3
    begin = np.concatenate([[0], np.cumsum(lengths)])
    line = np.full(begin[-1], 32, np.uint8)
    doc = np.repeat(np.arange(docs), lengths)
    line[np.arange(len(data)) + np.repeat(begin[:-1] + 2 - at[:-1], np.diff(at))] = _SIMPLE[data]
    wide = line.astype(np.uint32)
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:] if len(wide) > 2 else wide[:0]
    used = (line[1:-1] != 32) if len(wide) > 2 else np.zeros(0, bool)  # the middle is a letter
    code, owner = code[used], doc[1:-1][used] if len(wide) > 2 else doc[:0]
    cell = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    return np.bincount(owner * CELLS + cell, minlength=docs * CELLS).reshape(docs, CELLS)


def vectors(data: np.ndarray, at: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts(data, at)).astype(np.float32) * idf.astype(np.float32)
    size = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(size > 0, size, 1)


def spherical(v: np.ndarray, k: int) -> np.ndarray:
    """Up to k unit centroids of unit rows; starts from the first row and those furthest off."""
    chosen, best = [0], v @ v[0]
    while len(chosen) < min(k, len(v)) and best.min() < 0.9999:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, v @ v[chosen[-1]])
    centres = v[chosen]
    for _ in range(SWEEPS):
        near = (v @ centres.T).argmax(1)
        sums = np.stack([v[near == j].sum(0) if (near == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


@dataclass
class Model:
    languages: list[str]
    of_centre: np.ndarray
    centres: np.ndarray
    idf: np.ndarray
    furthest: float

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        data, at = flat(column)
        alpha = ((data | 0x20) >= 97) & ((data | 0x20) < 123)
        seen = np.concatenate([[0], np.cumsum(alpha)])
        letters = seen[at[1:]] > seen[at[:-1]]
        for k in np.flatnonzero(~letters & (np.diff(at) > 0)).tolist():
            letters[k] = any(c.isalpha() for c in column[k].as_py())
        if not self.languages:
            return [UNKNOWN] * len(letters), np.zeros(len(letters))
        near = vectors(data, at, self.idf) @ self.centres.T
        best = near.argmax(1)
        score = np.clip(near[np.arange(len(best)), best].astype(float), 0, 1)
        kept = letters & (1 - score <= self.furthest)
        names = [self.languages[self.of_centre[b]] if ok else UNKNOWN for b, ok in zip(best, kept, strict=True)]
        return names, np.where(kept, score, 0.0)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(CELLS, np.int64), 0
    for piece in pieces(batches, rows=PIECE_ROWS):
        total += (counts(*flat(piece.column("text"))) > 0).sum(0)
        docs += piece.num_rows
    cells = [pa.array(np.append(np.arange(CELLS), -1)), pa.array(np.append(total, docs))]
    yield pa.RecordBatch.from_arrays(cells, ["cell", "n"])


def fit(docs: DataFrame, usable: Column, furthest: float = 1.0) -> Model:
    """Learn from the text and lang of the documents for which ``usable`` (over doc_id) holds.

    Rows that share an id are samples of their own, each with its text and language; equal rows
    are one. Clusters are made of up to ``LANGUAGE_ROWS`` rows a language, ``SAMPLE_ROWS`` in all,
    those with the least hash of their id.

    ``furthest`` is the largest cosine distance at which a language is still accepted.
    """
    ship(docs.sparkSession)
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = known.select("text").mapInArrow(_frequencies, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(CELLS + 1)
    for r in rows:  # one row a cell, and the number of documents
        n[r["cell"]] = r["n"]
    idf = np.log((1 + n[-1]) / (1 + n[:-1])) + 1e-3
    own = known.select(F.col("doc_id"), F.col("text"), F.col("lang").alias("y")).withColumn("_content", F.xxhash64("text"))
    key = ["doc_id", "_content", "y"]
    # A language is picked from by share first, so that only SHARES times its rows meet in one task.
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("_content")]
    shares = own.select(*key, F.pmod(F.xxhash64("doc_id", "_content"), F.lit(SHARES)).alias("share"))
    shares = shares.withColumn("place", F.dense_rank().over(Window.partitionBy("y", "share").orderBy(*order)))
    shares = shares.where(F.col("place") <= LANGUAGE_ROWS).groupBy("y", "share", "doc_id", "_content").agg(F.count("*"))
    place = F.row_number().over(Window.partitionBy("y").orderBy(*order))
    picked = shares.withColumn("place", place).where(F.col("place") <= LANGUAGE_ROWS)
    picked = picked.orderBy("place", "y", "doc_id", "_content").limit(SAMPLE_ROWS).select(*key)
    # Every picked row keeps its own text and language; rows that repeat are one.
    sample = own.join(F.broadcast(picked), key).groupBy(*key).agg(F.min("text").alias("text")).drop("_content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, rows=PIECE_ROWS):
            v = vectors(*flat(piece.column("text")), idf).astype(np.float16)
            raw = pa.array([r.tobytes() for r in v], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("y"), raw], ["doc_id", "y", "v"])

    found = sample.mapInArrow(run, "doc_id bigint, y string, v binary").orderBy("y", "doc_id", "v").collect()
    names = sorted({r["y"] for r in found})
    centres, of = [], []
    for k, name in enumerate(names):
        own = np.stack([np.frombuffer(r["v"], np.float16) for r in found if r["y"] == name]).astype(np.float32)
        centres.append(spherical(own, CENTROIDS))
        of += [k] * len(centres[-1])
    return Model(names, np.array(of, int), np.concatenate(centres) if centres else np.zeros((0, CELLS), np.float32), idf, furthest)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (cosine to the nearest centroid) of every text."""
    ship(docs.sparkSession)
    fixed = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, rows=PIECE_ROWS):
            names, score = fixed.value.predict(piece.column("text"))
            columns = [piece.column("doc_id"), pa.array(names, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
