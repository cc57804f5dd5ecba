"""Quality classifier: an additive model with pairwise interactions over text features (operator 1).

Features are computed from the bytes of whole texts by vectorised code inside Spark tasks. The
model is fitted on the driver from the features of a bounded sample of labelled rows (see
``samples.SAMPLE_ROWS``; a row is some twenty numbers), and scores every text by adding up
entries of its lookup tables.

Defined cases: null and empty texts are scored alike, as texts without words; without any
label every text gets the score 0.5 or the labels' share; equal rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from pigeonhole.llm import gam
from pigeonhole.llm.features import NAMES, dense
from pigeonhole.llm.samples import SAMPLE_ROWS, labelled
from pigeonhole.llm.tables import texts
from pigeonhole.llm.text import flat, pieces


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        x = dense(*flat(piece.column("text")))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists, piece.column("y")], ["doc_id", "x", "y"])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> gam.Model:
    """Learn from the labelled documents for which ``usable`` (over doc_id) holds."""
    sample = labelled(docs, labels, "quality", usable, rows)
    found = sample.mapInArrow(_rows, "doc_id bigint, x array<double>, y int").orderBy("doc_id", "y", "x").collect()
    x = np.array([r["x"] for r in found]).reshape(-1, len(NAMES))
    return gam.fit(x, np.array([r["y"] for r in found], float))


def score(docs: DataFrame, model: gam.Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            s = model.score(dense(*flat(piece.column("text"))))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id bigint, score double")
