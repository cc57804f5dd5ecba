"""Packing token sequences by non-negative least squares over length combinations (operator 10).

1. Documents are tokenised once. Each is cut into pieces of a whole window and one remainder;
   pieces, with the checksum of their ids and their rank among pieces of the same length and
   task, are written to the shared folder.
2. The histogram of remainder lengths has at most ``window - 1`` entries, whatever the corpus.
   Shallow combinations (one to three lengths) that fill a window are enumerated, their repeat
   counts solved against the histogram by non-negative least squares, and rounded down. What
   is left is packed greedily, longest first, each time as often as the histogram allows.
3. The plan is a list of rank ranges a length. A piece's rank over all tasks is its rank plus
   the counts of the tasks before, and the range it falls into gives sequence and offset.

Only histogram and plan are on the driver; both are bounded by the window.

Defined cases: a null or empty text has just the end id; an empty table gives no rows; equal
rows are packed each for itself; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pigeonhole.llm.tables import texts, written
from pigeonhole.llm.text import pieces

#: Sweeps of the least-squares solver; more change the padding by less than a part in a thousand.
SWEEPS = 300
ENCODE_BYTES = 2 << 20


def _check(spec: dict) -> None:
    """Raises unless the faster library would give the ids that the file asks for."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = {"dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"}
    if model.get("type") != "BPE" or any(model.get(k) for k in plain):
        raise ValueError("only plain byte-pair merges")
    if spec.get("normalizer") is not None:
        raise ValueError("only files without a normaliser")
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True):
        raise ValueError("only the standard byte-level splitting without an added blank")
    if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens must stand for exactly their text")
    ids = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        raise ValueError("merges must come in the order of their ids")


def byte_encoder(path: str):
    """A function from texts to id lists, equal to the tokenizer file's without added ids.

    Reads vocabulary and ranks for the faster of two public libraries that implement the same
    byte-level merges; special tokens in a text become their ids in both. What the file says of
    normalising, splitting and the order of merges is checked; a file that wants anything else
    than the standard byte-level splitting, or merges in another order than that of the ids, is
    an error.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    _check(spec)
    points = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(points)]
    byte_of = {chr(b): b for b in points} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in added}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    special = tuple(added)

    def encode(batch: list[str]) -> list[list[int]]:
        return [encoding.encode(t, allowed_special="all") if any(s in t for s in special) else encoding.encode_ordinary(t) for t in batch]

    return encode


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, rank bigint"
_ENCODERS: dict[str, object] = {}


def _cut(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = byte_encoder(path)
        encode, seen, part = _ENCODERS[path], np.zeros(window + 1, np.int64), TaskContext.get().partitionId()
        for piece in pieces(batches, limit=ENCODE_BYTES):
            ids = piece.column("doc_id").to_pylist()
            tokens = encode([t or "" for t in piece.column("text").to_pylist()])
            rows = []
            for doc, own in zip(ids, tokens, strict=True):
                flat = np.array([*own, end_id], "<u4")
                for start in range(0, len(flat), window):
                    cut = flat[start : start + window]
                    rows.append((doc, start, len(cut), zlib.crc32(cut), len(flat), part, seen[len(cut)]))
                    seen[len(cut)] += 1
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All one to three of the given lengths that sum to the window, padded with 0, as rows."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    rows = []
    for a in lengths[lengths <= window // 2]:
        if have[window - a]:
            rows.append([[window - a, a, 0]])
        b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
        c = window - a - b
        b, c = b[have[c]], c[have[c]]
        rows.append(np.stack([c, b, np.full(len(b), a)], 1))
    return np.concatenate([np.asarray(r, np.int64).reshape(-1, 3) for r in rows]) if rows else np.zeros((0, 3), np.int64)


def solve(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' lengths near the histogram.

    Multiplicative descent, which keeps every count non-negative; the matrix of patterns is
    held by its up to three entries a column.
    """
    size = len(histogram)

    def gather(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        v[0] = 0
        return v[patterns].sum(1)

    def spread(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(patterns[:, k], x, size) for k in range(3))

    goal = gather(histogram.astype(float))
    per_length = np.maximum(np.bincount(patterns.ravel(), minlength=size), 1)
    x = (histogram / per_length)[np.where(patterns > 0, patterns, patterns[:, :1])].min(1)
    for _ in range(SWEEPS):
        x *= goal / np.maximum(gather(spread(x)), 1e-12)
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how many sequences each makes; uses every piece once."""
    left, out = histogram.astype(np.int64).copy(), []
    patterns = combinations(np.flatnonzero(left), window)
    if len(patterns):
        counts = solve(patterns, left)
        for k in np.argsort(-counts, kind="stable"):
            want = int(counts[k])
            if want == 0:
                break
            lengths, each = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
            times = min(want, int((left[lengths] // each).min()))
            if times:
                left[lengths] -= times * each
                out.append((tuple(int(v) for v in patterns[k] if v), times))
    while left.any():
        used, room, chosen = np.zeros_like(left), window, []
        while room:
            fits = np.flatnonzero((left - used)[: room + 1] > 0)
            if not len(fits):
                break
            chosen.append(int(fits[-1]))
            used[fits[-1]] += 1
            room -= int(fits[-1])
        lengths = np.flatnonzero(used)
        times = int((left[lengths] // used[lengths]).min())
        left -= times * used
        out.append((tuple(chosen), times))
    return out


def ranges(made: list[tuple[tuple[int, ...], int]], first: int, window: int) -> tuple[np.ndarray, ...]:
    """For each length in order, the first rank of every range, its sequence and its offset."""
    taken = np.zeros(window + 1, np.int64)
    rows, sequence = [], first
    for lengths, times in made:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = written(texts(docs).mapInArrow(_cut(tokenizer, window, end_id), PIECES), "pieces")
    counts = cut.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row a length
        histogram[r["length"]] = r["n"]
    whole, histogram[window] = int(histogram[window]), 0
    made = [((window,), whole)] * bool(whole) + plan(histogram, window)
    lengths, ranks, sequences, offsets = ranges(made, 0, window)
    fixed = spark.sparkContext.broadcast((lengths * (1 << 40) + ranks, ranks, sequences, offsets))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, starts, first, offset = fixed.value
        for b in batches:
            rank = b.column("rank").to_numpy() + b.column("base").to_numpy()
            at = np.searchsorted(keys, b.column("length").to_numpy() * (1 << 40) + rank, "right") - 1
            kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            added = [pa.array(first[at] + rank - starts[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + added, [*kept, "sequence_id", "offset"])

    out = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return cut.join(bases, ["part", "length"]).mapInArrow(place, out)
