"""SentencePiece byte-pair encoding and decoding by vectorised merge rounds (operator 2).

A piece of a batch is one array of code points with every blank as the word mark and one mark
put before each text. No vocabulary entry has a mark after another character, so merges never
cross from one unit (marks, then other characters) into the next, and each distinct unit is
encoded once. All distinct units are worked on at the same time: in every round the best pair
of each unit is found with a segmented minimum over pair ranks, merged, and the arrays are
compacted; units without a pair leave. Where no better pair can come from a merge, all of a
unit's equal pairs merge in one round from the left, else only the leftmost. Runs of marks,
whose entries share the lowest score, come last and merge strictly from the left.

Defined cases: null and empty texts have no ids and decode to the empty text; characters
outside the vocabulary become byte ids; bytes that are not UTF-8 decode to U+FFFD each; null
ids decode to the empty text. Other columns are ignored; equal rows give equal rows.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.tables import texts
from pigeonhole.llm.text import flat, mix, pieces

MARK = 0x2581
_NONE = np.int32(2**31 - 1)
#: After so many rounds, what is left of long words is cut where no entry can go across any more.
ROUNDS = 16
#: An odd base of hashes, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Pairs of characters below this are looked up in a square table.
_LOW = 0x250
#: Larger pieces of a batch repeat more units; the arrays take some forty times this.
ENCODE_BYTES = 4 << 20


def _code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of flat UTF-8 texts and where each text starts among them."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    b = data[lead].astype(np.int32)
    size = 1 + (b >= 0xC0) + (b >= 0xE0) + (b >= 0xF0)
    out = np.where(size == 1, b, b & (0x7F >> size))
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] = (out[more] << 6) | (data[lead[more] + k] & 0x3F)
    return out, np.searchsorted(lead, at)


class Model:
    """Lookup tables of a byte-pair model file: identity normaliser, mark put before a text."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("Ａ  ﬁ") != "▁Ａ▁▁ﬁ":
            raise ValueError("only models that keep characters and put a mark before a text")
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = [i for i in range(len(names)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.size, mark = len(names), chr(MARK)
        ids = {names[i]: i for i in plain}
        scores = {i: sp.get_score(i) for i in plain}
        if any(mark in names[i].lstrip(mark) for i in plain):
            raise ValueError("a vocabulary entry has a word mark inside")
        self.marks = {len(names[i]): i for i in plain if not names[i].strip(mark)}
        lowest = min(scores.values())
        if any(scores[i] != lowest for n, i in self.marks.items() if n > 1):
            raise ValueError("runs of word marks must share the lowest score")
        rank = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.of_char = np.full(0x110000, self.size, np.int32)
        for i in plain:
            if len(names[i]) == 1:
                self.of_char[ord(names[i])] = i
        pairs = {}
        unsafe = np.zeros(len(rank), bool)
        for i in plain:
            if len(names[i]) < 2 or i in self.marks.values():
                continue
            for k in range(1, len(names[i])):
                a, b = ids.get(names[i][:k]), ids.get(names[i][k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (rank[scores[i]], i)
                    for part in (a, b):
                        unsafe[rank[scores[part]]] |= rank[scores[i]] <= rank[scores[part]]
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([*(pairs[k][0] for k in self.keys.tolist()), _NONE], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.unsafe = unsafe
        self._list_stretches(names, plain)
        # Characters that stand side by side in some entry; no merge goes across any others.
        beside = {ord(a) << 21 | ord(b) for i in plain for a, b in zip(names[i], names[i][1:], strict=False)}
        self.beside = np.array(sorted(beside), np.int64)
        self.beside_low = np.zeros((_LOW, _LOW), bool)
        low = self.beside[(self.beside >> 21 < _LOW) & ((self.beside & 0x1FFFFF) < _LOW)]
        self.beside_low[low >> 21, low & 0x1FFFFF] = True
        #: A table from a key's slot to the first sorted key with that slot, so that most lookups take one step.
        self.bits = 21
        slot = (mix(self.keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        self.slot_keys, self.slot_at = self.keys[order], order.astype(np.int32)
        self.first = np.searchsorted(slot[order], np.arange(1 << self.bits)).astype(np.int32)
        self.most = int(np.bincount(slot).max())
        self.slot_keys = np.concatenate([self.slot_keys, np.full(self.most, -1)])
        self.slot_at = np.concatenate([self.slot_at, np.zeros(self.most, np.int32)])
        byte_ids = {int(names[i][1:-1], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], np.int32)
        values = [b""] * self.size
        for i in plain:
            values[i] = names[i].replace(mark, " ").encode()
        for b, i in byte_ids.items():
            values[i] = bytes([b])
        for i in range(self.size):
            if sp.is_unknown(i):
                values[i] = " ⁇ ".encode()
        self.lengths = np.array([len(v) for v in values], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(values), np.uint8)

    def apart(self, cps: np.ndarray) -> np.ndarray:
        """Whether no vocabulary entry holds a character and the one before it side by side."""
        out = np.zeros(len(cps), bool)
        if len(cps) > 1:
            a, b = cps[:-1], cps[1:]
            low = (a < _LOW) & (b < _LOW)
            out[1:] = ~self.beside_low[np.where(low, a, 0), np.where(low, b, 0)]
            high = np.flatnonzero(~low)
            key = a[high].astype(np.int64) << 21 | b[high]
            at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
            out[high + 1] = self.beside[at] != key
        return out

    def _list_stretches(self, names: list[str], plain: list[int]) -> None:
        """Hashes of all stretches of characters that some entry holds, and of each entry."""
        entries = [names[i] for i in plain]
        cps = np.array([ord(c) for e in entries for c in e], np.uint64)
        lengths = np.array([len(e) for e in entries])
        begin = np.cumsum(lengths) - lengths
        self.powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE, np.uint64)) * np.uint64(_INVERSE)
        value, left = np.zeros(len(cps), np.uint64), np.repeat(begin + lengths, lengths) - np.arange(len(cps))
        self.hash_of, self.chars = np.zeros(self.size + 1, np.uint64), np.zeros(self.size + 1, np.int64)
        held = []
        for n in range(1, int(lengths.max()) + 1):
            at = np.flatnonzero(left >= n)
            value[at] += mix(cps[at + n - 1]) * self.powers[n - 1]
            held.append(np.unique(value[at]))
            whole = np.flatnonzero(lengths == n)
            self.hash_of[np.array(plain)[whole]] = value[begin[whole]]
        self.chars[plain] = lengths
        self.stretches = np.unique(np.concatenate(held))

    def parted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no entry holds the characters of two symbols on end, so that none goes across."""
        known = (a < self.size) & (b < self.size)
        n = np.minimum(self.chars[a], len(self.powers) - 1)
        both = self.hash_of[a] + self.powers[n] * self.hash_of[b]
        at = np.minimum(np.searchsorted(self.stretches, both), len(self.stretches) - 1)
        return ~known | (self.stretches[at] != both)

    def pair_index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of each pair in ``ranks`` and ``merged``, -1 where there is none."""
        key = a.astype(np.int64) * self.size + b
        at = self.first[(mix(key.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)]
        out = np.where(self.slot_keys[at] == key, self.slot_at[at], -1)
        for k in range(1, self.most):
            miss = np.flatnonzero(out < 0)
            hit = miss[self.slot_keys[at[miss] + k] == key[miss]]
            out[hit] = self.slot_at[at[hit] + k]
        out[(a >= self.size) | (b >= self.size)] = -1
        return out

    @lru_cache(maxsize=4096)  # noqa: B019 - models live as long as the worker
    def mark_run(self, n: int) -> tuple[int, ...]:
        """How a run of n marks merges when equal pairs go from the left."""
        done: list[int] = []
        while n:
            if done and done[-1] + 1 in self.marks:
                done[-1] += 1
                n -= 1
            elif n > 1 and 2 in self.marks:
                done.append(2)
                n -= 2
            else:
                done.append(1)
                n -= 1
            while len(done) > 1 and done[-2] + done[-1] in self.marks:
                done[-2:] = [done[-2] + done[-1]]
        return tuple(done)

    def _at_once(self, sym, last, index, rank, chosen: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Which of the choices merge together: all of a unit up to the first one whose merge
        makes a pair that comes before the next choice.

        Such a pair has no larger rank. Only ranks that some entry goes on from like that are
        looked at, each with the symbols that will be beside it then.
        """
        open_ = np.flatnonzero(self.unsafe[rank[chosen]])
        if not len(open_):
            return np.ones(len(chosen), bool)
        at = chosen[open_]
        own, limit = self.merged[index[at]], rank[at]
        after = np.minimum(at + 2, len(sym) - 1)
        ends = last[at + 1] | (at + 2 >= len(sym))
        soon = ~ends & (self.ranks[self.pair_index(own, sym[after])] <= limit)
        before = np.maximum(at - 1, 0)
        beside = sym[before]
        # The symbol before is one just merged, if the choice before ends there.
        follows = np.flatnonzero((open_ > 0) & (chosen[np.maximum(open_ - 1, 0)] == at - 2))
        beside[follows] = self.merged[index[chosen[open_[follows] - 1]]]
        starts = (at == 0) | last[before]
        soon |= ~starts & (self.ranks[self.pair_index(beside, own)] <= limit)
        waits = np.zeros(len(chosen), np.int64)
        waits[open_] = soon
        earlier = np.cumsum(waits) - waits
        first = np.concatenate([[True], of[1:] != of[:-1]])
        return earlier == earlier[np.maximum.accumulate(np.where(first, np.arange(len(of)), 0))]

    def encode_units(self, cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units on end, and how many each unit has."""
        total = len(cps)
        out = np.full(total, -1, np.int32)
        sym, src = self.of_char[cps], np.arange(total, dtype=np.int32)
        lengths = np.diff(np.append(starts, total))
        # last: whether a symbol ends its unit. index: of the pair that starts here, -1 without.
        last = np.zeros(total, bool)
        last[starts[1:] - 1] = last[-1:] = True
        index = np.full(total, -1, np.int32)
        if total > 1:
            index[:-1] = self.pair_index(sym[:-1], sym[1:])
        index[last] = -1
        rank = self.ranks[index]  # the entry at -1 stands for no pair
        rounds = 0
        while len(sym):
            rounds += 1
            if rounds % ROUNDS == 0:
                cut = np.flatnonzero(~last[:-1])
                cut = cut[self.parted(sym[cut], sym[cut + 1])]
                last[cut], index[cut], rank[cut] = True, -1, _NONE
            begins = np.flatnonzero(last[:-1]) + 1
            begins = np.concatenate([[0], begins])
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(sym)))
            done = best == _NONE
            if done.any():
                over = np.repeat(done, sizes)
                out[src[over]] = sym[over]
                keep = np.flatnonzero(~over)
                sym, src, last, index, rank = sym[keep], src[keep], last[keep], index[keep], rank[keep]
                best, sizes = best[~done], sizes[~done]
                if not len(sym):
                    break
            owner = np.repeat(np.arange(len(best), dtype=np.int32), sizes)
            chosen = np.flatnonzero(rank == best[owner])
            of = owner[chosen]
            if len(chosen) > len(best):
                fresh = np.concatenate([[True], of[1:] != of[:-1]])
                # Of neighbouring choices every second one from the left.
                new = fresh | np.concatenate([[True], chosen[1:] != chosen[:-1] + 1])
                place = np.arange(len(chosen))
                even = (place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0
                chosen, of = chosen[even], of[even]
                chosen = chosen[self._at_once(sym, last, index, rank, chosen, of)]
            sym[chosen] = self.merged[index[chosen]]
            last[chosen] = last[chosen + 1]
            keep = np.ones(len(sym), bool)
            keep[chosen + 1] = False
            at = chosen - np.arange(len(chosen))  # each earlier merge took one symbol away
            keep = np.flatnonzero(keep)
            sym, src, last, index, rank = sym[keep], src[keep], last[keep], index[keep], rank[keep]
            for again in (at, at[at > 0] - 1):
                open_ = again[~last[again]]
                index[again] = -1
                index[open_] = self.pair_index(sym[open_], sym[open_ + 1])
                rank[again] = self.ranks[index[again]]
        self._join_marks(out, cps, starts, lengths)
        kept = np.flatnonzero(out >= 0)
        ids, owner = out[kept], np.repeat(np.arange(len(starts)), lengths)[kept]
        strange = np.flatnonzero(ids == self.size)
        if len(strange):
            c = cps[kept[strange]]
            raw = "".join(map(chr, c.tolist())).encode()
            width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            times = np.ones(len(ids), np.int64)
            times[strange] = width
            hold = np.repeat(ids == self.size, times)
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            ids[hold] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        return ids, np.bincount(owner, minlength=len(starts))

    def _join_marks(self, out: np.ndarray, cps: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        single = self.marks[1]
        long = np.flatnonzero(lengths > 1)
        long = long[(out[starts[long]] == single) & (out[starts[long] + 1] == single)]
        for s, stop in zip(starts[long].tolist(), (starts + lengths)[long].tolist(), strict=True):
            rest = np.flatnonzero((cps[s:stop] != MARK) | (out[s:stop] != single))
            e = s + int(rest[0]) if len(rest) else stop
            out[s:e] = -1
            for n in self.mark_run(e - s):
                out[s] = self.marks[n]
                s += n

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of flat UTF-8 texts on end, and where each text starts among them."""
        cps, begin = _code_points(data, at)
        cps[cps == 0x20] = MARK
        filled = np.flatnonzero(begin[1:] > begin[:-1])
        cps = np.insert(cps, begin[filled], MARK)
        begin = begin + np.searchsorted(filled, np.arange(len(begin)))
        n = len(cps)
        if n == 0:
            return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
        is_mark = cps == MARK
        new = is_mark.copy()
        new[1:] &= ~is_mark[:-1]
        new[begin[:-1][begin[:-1] < n]] = True
        # A long word falls into stretches that merge apart from each other, many at once.
        new |= self.apart(cps) & ~(is_mark & np.concatenate([[False], is_mark[:-1]]))
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, n))
        place = np.arange(n) - np.repeat(starts, lengths)
        hashes = np.add.reduceat(mix(((place << 21) + cps).astype(np.uint64)), starts)
        _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        same = lengths[first][of] == lengths
        if same.all():
            same = (cps == cps[np.repeat(starts[first][of], lengths) + place]).all()
        if not np.all(same):  # a clash of hashes: take every unit by itself
            first = of = np.arange(len(starts))
        d_len = lengths[first]
        d_start = np.cumsum(d_len) - d_len
        own = np.arange(d_len.sum()) - np.repeat(d_start, d_len) + np.repeat(starts[first], d_len)
        ids, count = self.encode_units(cps[own], d_start)
        id_start = np.cumsum(count) - count
        times = count[of]
        ends = np.concatenate([[0], np.cumsum(times)])
        take = np.arange(ends[-1]) + np.repeat(id_start[of] - ends[:-1], times)
        return ids[take], ends[np.searchsorted(starts, begin)]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of flat ids, and where each text starts."""
        lengths = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        data = self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends[:-1], lengths)]
        begin = ends[at]
        filled = np.flatnonzero(at[1:] > at[:-1])
        filled = filled[(lengths[at[filled]] > 0) & (self.lengths[ids[at[filled]]] > 0)]
        filled = filled[(data[begin[filled]] == 0x20) & (ids[at[filled]] != self.byte_ids[0x20])]
        keep = np.ones(len(data), bool)
        keep[begin[filled]] = False
        begin = begin - np.searchsorted(filled, np.arange(len(begin)))
        return data[keep], begin


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("pigeonhole-each-byte", _each_byte)
_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every text, without begin or end ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for piece in pieces(batches, limit=ENCODE_BYTES):
            ids, at = m.encode(*flat(piece.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and text of every row of ids, as the library decodes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                lists = part.column("ids")
                if lists.null_count:
                    lists = pa.array([v or [] for v in lists.to_pylist()], lists.type)
                at = lists.offsets.to_numpy().astype(np.int64)
                data, begin = m.decode(lists.values.to_numpy()[at[0] : at[-1]], at - at[0])
                raw = data.tobytes()
                try:
                    raw.decode()
                    offsets = pa.py_buffer(begin.astype(np.int32))
                    text = pa.Array.from_buffers(pa.string(), len(begin) - 1, [None, offsets, pa.py_buffer(raw)])
                except UnicodeDecodeError:
                    cut = zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)
                    text = pa.array([raw[a:b].decode(errors="pigeonhole-each-byte") for a, b in cut], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), text], ["doc_id", "ids", "text"])

    kept = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    return kept.mapInArrow(run, "doc_id bigint, ids array<int>, text string")
