"""Operators 2 and 10 against the public libraries."""

import base64
import collections
import hashlib
import json
import random
import string
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pigeonhole.llm import packing, queries, sentencepieces
from pigeonhole.llm.text import flat

PIECES = queries.tokenizer("piece_bpe_32k.model")
BYTES = queries.tokenizer("byte_bpe_50k.json")
PARTS = ["a", "aa", "the", "  ", " ", "▁", "é", "日本", "\n", "\t", "\x00", "<s>", "ing", "🙂", "Ａ", "....", "====", " " * 15,
         " " * 31, "́", "한국", "in", "re", "er", "<|endoftext|>", "'s", "123", "'"]


def mixed(seed, count):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 60))) for _ in range(count)] + ["", None, " ", "▁", "a" * 5000, " " * 3000]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_the_library(library):
    model = sentencepieces.Model(PIECES)
    texts = mixed(1, 400)
    ids, at = model.encode(*flat(pa.array(texts, pa.string())))
    data, begin = model.decode(ids, at)
    for k, t in enumerate(texts):
        want = library.encode(t or "")
        assert ids[at[k] : at[k + 1]].tolist() == want
        assert data[begin[k] : begin[k + 1]].tobytes().decode() == library.decode(want)


def test_decoding_of_any_ids(spark, library):
    r = random.Random(2)
    lists = [[r.randrange(3, 32000) for _ in range(r.randint(0, 12))] for _ in range(60)] + [[3 + 0xFF, 3 + 0xE2, 3 + 0x96, 300], [], None]
    encoded = spark.createDataFrame(list(enumerate(lists)), "doc_id bigint, ids array<int>")
    for row in sentencepieces.decode(encoded, PIECES).collect():
        assert row["text"] == library.decode(lists[row["doc_id"]] or [])


def test_encoding_query(spark, documents, sf_dir, library):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op2_sentencepiece"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        ids = library.encode(t)
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encoding_of_null_empty_and_repeated_rows(docs_of):
    docs = docs_of([(1, None), (1, None), (2, ""), (None, "a b")]).withColumnRenamed("lang", "ids")
    found = sorted((r["doc_id"] or 0, list(r["ids"])) for r in sentencepieces.encode(docs, PIECES).collect())
    assert [f[0] for f in found] == [0, 1, 1, 2] and found[1:] == [(1, []), (1, []), (2, [])]
    assert sentencepieces.encode(docs.limit(0), PIECES).count() == 0


def check_packing(rows, texts, window=1024):
    """Every id is in one piece, sequences are gapless and hold no more than the window."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    by = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    return 1 - sum(r["length"] for r in rows) / max(1, window * len(sequences))


def test_packing_query(spark, documents, sf_dir):
    rows = queries.QUERIES["op10_packing"](spark, sf_dir).collect()
    padding = check_packing(rows, list(zip(documents.doc_id.tolist(), documents.text.tolist(), strict=True)))
    assert padding < 0.03  # 200 documents leave little to combine; a thousand have 0.3 %


def test_packing_of_odd_texts(docs_of):
    texts = [t for t in enumerate(mixed(4, 60))]
    check_packing(packing.pack(docs_of(texts), BYTES).collect(), texts)
    assert packing.pack(docs_of(texts).limit(0), BYTES).count() == 0
    again = packing.pack(docs_of([(1, "a b"), (1, "a b"), (2, None)]).withColumnRenamed("lang", "length"), BYTES).collect()
    assert sorted(r["length"] for r in again) == [1, 3, 3] and {r["sequence_id"] for r in again} == {0}


def test_a_plan_uses_every_piece_once():
    r = np.random.default_rng(0)
    for window in (16, 64, 1024):
        histogram = r.integers(0, 40, window + 1)
        histogram[[0, window]] = 0
        used = np.zeros_like(histogram)
        for lengths, times in packing.plan(histogram, window):
            assert sum(lengths) <= window and times > 0
            for n in lengths:
                used[n] += times
        assert (used == histogram).all()


def long_words():
    draw = random.Random(7)
    yield base64.b64encode(draw.randbytes(750_000)).decode()
    yield "".join(draw.choices(string.ascii_lowercase, k=300_000))
    yield "".join(draw.choices(["the", "ing", "tion", "er", "and", "of", "in", "com", "est"], k=60_000))
    yield from ("the" * 100_000, "a" * 200_000, "es" * 100_000, "=-" * 50_000, "日本語" * 30_000)


def test_long_words_take_few_rounds():
    """A million characters without a blank, in seconds and as the library has them."""
    import sentencepiece

    m, library = sentencepieces.model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in long_words():
        begin = time.perf_counter()
        ids, _ = m.encode(*flat(pa.array([text])))
        assert time.perf_counter() - begin < 20
        assert ids.tolist() == library.encode(text)


def test_words_of_few_letters_merge_as_in_the_library():
    import sentencepiece

    m, library = sentencepieces.model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    draw = random.Random(8)
    texts = []
    for _ in range(1500):
        letters = draw.choice(["ab", "the", "esti", "thei ", "aeiounst", "=-_*", " ta", "日本a語 "])
        part = "".join(draw.choices(letters, k=draw.randrange(1, 40)))
        texts.append(part * draw.choice([1, 1, 2, 9]))
    ids, at = m.encode(*flat(pa.array(texts)))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == library.encode(text), text


def test_tokenizer_files_of_another_kind_are_refused(tmp_path):
    with open(BYTES, encoding="utf-8") as f:
        spec = json.load(f)
    packing._check(spec)
    changes = {
        "normalizer": {"type": "NFC"},
        "pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True},
        "model": spec["model"] | {"merges": spec["model"]["merges"][::-1]},
    }
    for name, value in changes.items():
        path = tmp_path / "file.json"
        path.write_text(json.dumps(spec | {name: value}))
        with pytest.raises(ValueError):
            packing.byte_encoder(str(path))
