"""Periodic runs of words: stretches that repeat one sequence of words three times or more.

A word of a run of period q comes again after q words, so in a run of ``times`` periods every
word occurs ``times`` times at least. A word that is rarer than that in a stretch of text lies in
no run there and splits it; the parts are counted anew, until no part has a rare word left or it
is too short. Only what survives is scanned for repeats at a distance.

A run of period q gives max(least, times * q) - q matches at lag q in a row. One position in so
many is tried for each lag, which takes n log n tries for n words in all; where it matches, the
stretch of matches around it is measured by bisection over prefix hashes. Runs found are then
compared word by word; a segment where that fails, as hashes can be wrong, is scanned plainly.

A text is worked on as a whole in one task; texts are independent, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pigeonhole.llm.tables import texts
from pigeonhole.llm.text import U64, Words, _powers, flat, mix, pieces

#: A run has this many words and this many periods at least.
LEAST, TIMES = 24, 3
#: Pairs of lag and position that are tried at once.
TRIES = 1 << 20
#: So many matches at most are looked for beside a try before the stretch around it is measured.
BESIDE = 7
BLANK = 0x20

#: The runs, by start and period, and the words that are left of each text.
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, on end."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - starts, counts)


def segments(word: np.ndarray, of_doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the stretches of ``word`` that have no word fewer than ``times`` times."""
    starts, stops = of_doc[:-1], of_doc[1:]
    names = int(word.max()) + 1 if len(word) else 1
    done = []
    while True:
        long = stops - starts >= least
        starts, stops = starts[long], stops[long]
        if not len(starts):
            break
        own = np.repeat(np.arange(len(starts)), stops - starts)
        at = _ranges(starts, stops - starts)
        _, which, count = np.unique(own * names + word[at], return_inverse=True, return_counts=True)
        common = count[which] >= times
        split = np.bincount(own, ~common, len(starts)) > 0
        done.append((starts[~split], stops[~split]))
        part = common & split[own]
        edge = np.append(own[1:] != own[:-1], True)  # the last of its segment
        begins = part & (np.insert(edge[:-1], 0, True) | ~np.insert(common[:-1], 0, False))
        ends = part & (edge | ~np.append(common[1:], False))
        starts, stops = at[begins], at[ends] + 1
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, stops = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(starts, kind="stable")
    return starts[order], stops[order]


class Prefixes:
    """Prefix hashes of a sequence, by which equal stretches of it are measured."""

    def __init__(self, word: np.ndarray):
        up, self.down = _powers(0, len(word) + 1)
        self.total = np.zeros(len(word) + 1, U64)
        np.cumsum(mix(word.astype(U64)) * up[: len(word)], out=self.total[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n items from a hash as n items from b."""
        return (self.total[a + n] - self.total[a]) * self.down[a] == (self.total[b + n] - self.total[b]) * self.down[b]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many items, ``most`` at most, are equal from a and b on, or before them."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            n = (low[open_] + high[open_] + 1) >> 1
            shift = n if back else 0
            same = self.equal(a[open_] - shift, b[open_] - shift, n)
            low[open_[same]] = n[same]
            high[open_[~same]] = n[~same] - 1
            open_ = open_[low[open_] < high[open_]]
        return low


def _tries(starts: np.ndarray, stops: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments, lags and positions of which every run holds one, in bounded blocks."""
    lags = (stops - starts) // times
    first = np.cumsum(lags) - lags
    # Blocks of rows of (segment, lag); a row has few positions, as one in so many is tried.
    for begin in range(0, int(lags.sum()), TRIES):
        row = np.arange(begin, min(begin + TRIES, int(lags.sum())))
        of = np.searchsorted(first, row, "right") - 1
        lag = row - first[of] + 1
        step = np.maximum(least, times * lag) - lag
        count = (stops[of] - starts[of] - lag) // step
        ends = np.cumsum(count)
        low = 0
        while low < len(row):
            high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + TRIES, "right")), low + 1)
            each = count[low:high]
            at = np.repeat(starts[of[low:high]] - 1, each) + (_ranges(np.ones(len(each), np.int64), each)) * np.repeat(step[low:high], each)
            yield np.repeat(of[low:high], each), np.repeat(lag[low:high], each), at
            low = high


def _plain(word: np.ndarray, start: int, stop: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """The runs (start, stop, period) of one segment by comparison at every lag."""
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, (stop - start) // times + 1):
        same = np.diff((word[start : stop - lag] == word[start + lag : stop]).astype(np.int8), prepend=0, append=0)
        for a, b in zip(np.flatnonzero(same == 1), np.flatnonzero(same == -1), strict=True):
            if b - a + lag >= max(least, times * lag):
                found.setdefault((start + int(a), start + int(b) + lag), lag)
    return [(a, b, lag) for (a, b), lag in found.items()]


def _periods(rows: np.ndarray) -> np.ndarray:
    """Of stretches (start, stop, lag, segment) the least lag each: a run of period q also
    repeats at multiples of q, over the same stretch."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def _holds(word: np.ndarray, start: int, stop: int, lag: int, low: int, high: int) -> bool:
    """Whether a stretch has this period and no neighbour within low..high goes on with it."""
    inside = np.array_equal(word[start : stop - lag], word[start + lag : stop])
    before = start == low or word[start - 1] != word[start - 1 + lag]
    return inside and before and (stop == high or word[stop] != word[stop - lag])


def find(word: np.ndarray, of_doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and smallest periods of all runs of flat texts, by start and period.

    ``word`` numbers the words from 0; ``of_doc`` has where each text starts and the last ends.
    """
    starts, stops = segments(word, of_doc, least, times)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    hashes = Prefixes(word)
    # Of the shortest stretch of matches that a run gives, half at least lies on one side of a try.
    middle = least // times
    beside = min(min(least - middle, (times - 1) * (middle + 1)) // 2, BESIDE)
    found = []
    period_at, stop_at = (np.zeros(len(word), np.int64) for _ in range(2))
    for of, lag, at in _tries(starts, stops, least, times):
        # Inside a run of period p, a multiple of p finds nothing but that run.
        known = np.maximum(period_at[at], 1)
        same = np.flatnonzero((word[at] == word[at + lag]) & ((at + lag >= stop_at[at]) | (lag % known != 0)))
        of, lag, at = of[same], lag[same], at[same]
        low, high = starts[of], stops[of]
        ahead, behind = np.ones(len(at), bool), np.ones(len(at), bool)
        last = len(word) - 1
        for k in range(1, beside + 1):
            ahead &= (at + lag + k < high) & (word[np.minimum(at + k, last)] == word[np.minimum(at + lag + k, last)])
            behind &= (at - k >= low) & (word[np.maximum(at - k, 0)] == word[np.maximum(at + lag - k, 0)])
        near = np.flatnonzero(ahead | behind)
        of, lag, at, low, high = of[near], lag[near], at[near], low[near], high[near]
        after = hashes.common(at, at + lag, high - at - lag, False)
        before = hashes.common(at, at + lag, at - low, True)
        length = before + after + lag
        good = np.flatnonzero(length >= np.maximum(least, times * lag))
        found.append(_periods(np.stack([at[good] - before[good], at[good] - before[good] + length[good], lag[good], of[good]], 1)))
        for a, b, p, _ in found[-1]:
            if b > stop_at[a]:
                period_at[a:b], stop_at[a:b] = p, b
    rows = _periods(np.concatenate(found))
    wrong = {int(of) for a, b, lag, of in rows if not _holds(word, a, b, lag, starts[of], stops[of])}
    if wrong:
        again = [r for of in wrong for r in _plain(word, int(starts[of]), int(stops[of]), least, times)]
        rows = np.concatenate([rows[~np.isin(rows[:, 3], list(wrong)), :3], np.array(again, np.int64).reshape(-1, 3)])
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def _on_end(words: Words, which: np.ndarray, of_doc: np.ndarray) -> pa.Array:
    """Texts of the words of these numbers joined by one blank; ``of_doc`` cuts ``which`` into texts."""
    length = words.ends[which] - words.starts[which] + 1
    stop = np.cumsum(length)
    small = np.int32 if len(words.data) + int(length.sum()) < 1 << 31 else np.int64
    source = np.arange(int(length.sum()), dtype=small)
    source += np.repeat((words.starts[which] - stop + length).astype(small), length)
    out = words.data[np.minimum(source, max(len(words.data) - 1, 0))] if len(source) else np.zeros(0, np.uint8)
    out[stop - 1] = BLANK
    # Without the blank after each text's last word.
    counts = np.diff(of_doc)
    ends = np.append(0, stop)[of_doc[1:]]
    out = np.delete(out, ends[counts > 0] - 1)
    sizes = np.diff(np.append(0, stop)[of_doc]) - (counts > 0)
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(out))])


def collapse(docs: DataFrame, rewritten: Callable[[int, int], tuple[int, int] | None] | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    A run is a stretch of consecutive words of smallest period q, with ``least`` words and
    ``times`` periods at least, that no neighbouring word extends with that period; runs are listed
    by start and period. ``collapsed`` has the words left, joined by one blank, when of every run
    only its first q words stay (a word goes if any run holds it after its first q words).

    ``rewritten``, for tests of the operator, gives for an id and its number of words a pair (a, p):
    from word a on, the words are then a to a + p - 1 of the original over and over.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Rows of null or
    equal ids are texts of their own. An empty table gives no rows. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = Words(*flat(piece.column("text")))
            of_doc = words.of_doc
            which = np.arange(len(words.starts))
            for k, doc_id in enumerate(piece.column("doc_id").to_pylist() if rewritten else ()):
                begin, n = int(of_doc[k]), int(of_doc[k + 1] - of_doc[k])
                change = rewritten(doc_id, n) if doc_id is not None and n else None
                if change:
                    a, p = change
                    which[begin + a : begin + n] = begin + a + np.arange(n - a) % p
            _, word = np.unique(words.hashes(), return_inverse=True)
            start, stop, period = find(word[which], of_doc, least, times)
            doc = np.searchsorted(of_doc, start, "right") - 1
            edge = np.zeros(len(which) + 1, np.int32)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, stop, -1)
            stays = np.cumsum(edge[:-1]) == 0
            kept_of = np.append(0, np.cumsum(stays))[of_doc]
            fields = [pa.array(x) for x in (start - of_doc[doc], stop - start, period)]
            offsets = pa.array(np.searchsorted(doc, np.arange(piece.num_rows + 1)).astype(np.int32))
            runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            collapsed = _on_end(words, which[stays], kept_of).cast(pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.diff(of_doc)), runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return texts(docs).mapInArrow(run, SCHEMA)
