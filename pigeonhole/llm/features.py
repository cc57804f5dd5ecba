"""Dense features of whole texts, computed for all texts of a piece at once."""

from __future__ import annotations

import numpy as np

from pigeonhole.llm.text import LOWER, WORD_BYTE, Words, rolling, span_hashes, starts_within

_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1  # upper
_CLASS[97:123] = 2  # lower
_CLASS[48:58] = 3  # digit
for _b in b".,;:'\"()-?":
    _CLASS[_b] = 4  # usual punctuation
for _b in b"#$%&*|<>{}[]=+~^_\\/@`":
    _CLASS[_b] = 5  # symbols
_CLASS[ord("!")] = 6
_CLASS[128:] = 7

NAMES = (
    "log_bytes", "log_words", "word_bytes", "long_words", "upper", "digit", "punctuation", "symbol",
    "exclamation", "other", "upper_first", "symbol_last", "no_letter", "line_words", "lines_repeated",
    "words_repeated", "same_as_last", "trigrams_repeated", "commonest", "stops",
)


def per_doc(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of a mask or of values over each text."""
    total = np.zeros(len(mask) + 1, np.int64 if mask.dtype != float else float)
    np.cumsum(mask, out=total[1:])
    return (total[at[1:]] - total[at[:-1]]).astype(float)


def repeated(values: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text, the share of values that come again, and that of its commonest value."""
    n = np.bincount(doc, minlength=docs)
    key = (values >> np.uint64(24)) | (doc.astype(np.uint64) << np.uint64(40))
    key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    owner = (key[new] >> np.uint64(40)).astype(np.int64)
    count = np.diff(np.append(new, len(key)))
    distinct = np.bincount(owner, minlength=docs)
    most = np.zeros(docs)
    np.maximum.at(most, owner, count)
    return (n - distinct) / np.maximum(n, 1), most / np.maximum(n, 1)


def dense(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of features, in the order of NAMES, for each flat text."""
    docs, kind = len(at) - 1, _CLASS[data]
    size = np.diff(at).astype(float)
    some = np.maximum(size, 1)
    words = Words(data, at)
    n = words.counts.astype(float)
    each = np.maximum(n, 1)
    doc = np.repeat(np.arange(docs), words.counts)
    length = (words.ends - words.starts).astype(float)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum((kind == 1) | (kind == 2) | (kind == 7), out=letters[1:])
    bare = letters[words.ends] == letters[words.starts]
    first, last = kind[words.starts], kind[np.maximum(words.ends - 1, 0)]
    hashes = words.hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    again, most = repeated(hashes, doc, docs)
    at3, doc3 = starts_within(words.of_doc, 3)
    tri = rolling(hashes, 3)[at3]
    tri_again, _ = repeated(tri, doc3, docs)
    breaks = data == 10
    lines = per_doc(breaks, at) + 1
    line_hash, line_doc = _lines(data, at)
    line_again, _ = repeated(line_hash, line_doc, docs)
    alpha = np.maximum(per_doc((kind == 1) | (kind == 2), at), 1)
    return np.stack(
        [
            np.log1p(size), np.log1p(n), per_doc(length, words.of_doc) / each, per_doc(length > 14, words.of_doc) / each,
            per_doc(kind == 1, at) / alpha, per_doc(kind == 3, at) / some, per_doc(kind == 4, at) / some, per_doc(kind == 5, at) / some,
            per_doc(kind == 6, at) / some, per_doc(kind == 7, at) / some, per_doc(first == 1, words.of_doc) / each,
            per_doc((last == 5) | (last == 6), words.of_doc) / each, per_doc(bare, words.of_doc) / each,
            np.log1p(n / lines), line_again, again, per_doc(same, words.of_doc) / each, tri_again, most, per_doc(data == 46, at) / each,
        ],
        axis=1,
    )


def _lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines that are not empty, and the texts they are in."""
    inside = data != 10
    first = inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        edges = at[1:-1][at[1:-1] < len(data)]
        first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=kept[1:])
    lengths = np.diff(np.append(kept[starts], kept[-1]))
    return span_hashes(data[inside], lengths), np.searchsorted(at, starts, "right") - 1


#: Digits and signs that stand for letters (fixed values), after lower-casing.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_PLAIN = LOWER.copy()
for _k, _v in LEET.items():
    _PLAIN[ord(_k)] = ord(_v)
_LETTER = np.array([97 <= b < 123 or b >= 128 for b in range(256)])
#: Second-person words of the languages of the corpus (fixed values).
SECOND = ("you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi",
          "vous", "ton", "ta", "tes", "votre", "tú", "ti", "usted", "ustedes", "tus", "vosotros")


class Terms:
    """Words of letters, plain-cased, with hashes of their first four characters and of all."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        plain = _PLAIN[data]
        if len(data) > 1:  # capitals of the Latin-1 letters
            high = np.flatnonzero((data[1:] < 0x9F) & (data[1:] >= 0x80) & (data[:-1] == 0xC3)) + 1
            plain[high] += 0x20
        inside = _LETTER[plain] & WORD_BYTE[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = at[1:-1][(at[1:-1] < len(data)) & (at[1:-1] > 0)]
            first[edges], last[edges - 1] = inside[edges], inside[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.of_doc = np.searchsorted(starts, at)
        changed = np.zeros(len(data) + 1, np.int64)
        np.cumsum(inside & ~_LETTER[data | 0x20], out=changed[1:])
        self.masked = changed[ends] > changed[starts]
        lengths = ends - starts
        own = plain[inside]
        begin = np.cumsum(lengths) - lengths
        lead = np.zeros(len(own) + 1, np.int64)
        np.cumsum((own & 0xC0) != 0x80, out=lead[1:])
        self.chars = lead[begin + lengths] - lead[begin]
        self.whole = span_hashes(own, lengths)
        head = lead[1:] - np.repeat(lead[begin], lengths) <= 4
        taken = np.zeros(len(own) + 1, np.int64)
        np.cumsum(head, out=taken[1:])
        self.head = span_hashes(own[head], taken[begin + lengths] - taken[begin], 1)


def hash_words(words: tuple[str, ...]) -> np.ndarray:
    data = "".join(words).encode()
    return span_hashes(np.frombuffer(data, np.uint8), np.array([len(w.encode()) for w in words]))
