"""Operators 3, 6 and 9 against brute force."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from pigeonhole.llm import jaccard, queries, shared, suffixes, windows
from pigeonhole.llm.graphs import components

BITS = 16


def made_texts(seed=3):
    """Copies, near copies, shared passages, repeated words, short, empty and null texts."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["é", "The", "THE"]
    passage = [r.choice(vocabulary) for _ in range(70)]
    texts = []
    for _ in range(25):
        words = [r.choice(vocabulary) for _ in range(r.randint(5, 160))]
        if r.random() < 0.4:
            k = r.randrange(len(words))
            words[k:k] = passage[r.randint(0, 10) :]
        texts.append(words)
    for _ in range(25):
        words = list(r.choice(texts))
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        texts.append(words)
    out = [" ".join(t) for t in texts] + [" ".join(r.choice(texts)) + "\n" for _ in range(8)]
    out += [None, "", "   ", "one", "One", "a b c d", "a b c d", "a b c d e", "na " * 200, "na " * 180, "x" * 300, "x" * 200, None]
    r.shuffle(out)
    return list(enumerate(out))


def small(monkeypatch):
    for module in (windows, suffixes, jaccard):
        monkeypatch.setattr(module, "SKETCH_BITS", BITS)
    from pigeonhole.llm import repeats

    monkeypatch.setattr(repeats, "WHOLE_BITS", 12)


def check_words(rows, texts):
    got = sorted((r["doc_id"], r["n"], r["n_removed"], r["kept_sha"]) for r in rows if r["doc_id"] is not None)
    want = []
    for i, words, gone in brute.removed_words(texts):
        left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want.append((i, len(words), sum(gone), hashlib.sha256(left).hexdigest()))
    assert got == sorted(want)


def check_bytes(rows, texts):
    got = sorted((r["doc_id"], r["n"], r["n_removed"], r["n_spans"], r["kept_sha"]) for r in rows)
    want = []
    for i, raw, gone in brute.removed_bytes(texts):
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        want.append((i, len(raw), sum(gone), brute.runs_of(gone), hashlib.sha256(left).hexdigest()))
    assert got == sorted(want)


def test_words_that_start_earlier_go(docs_of, monkeypatch):
    small(monkeypatch)
    texts = made_texts()
    rows = windows.dedup(docs_of(texts), BITS).collect()
    check_words(rows, texts)
    by = {r["doc_id"]: r for r in rows}
    for i, words, gone in brute.removed_words(texts):
        left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        assert by[i]["kept"] == (left if any(gone) else None)


def test_a_crowded_sketch_loses_nothing(docs_of, monkeypatch):
    """With far fewer cells than windows everything is estimated repeated; results are the same."""
    small(monkeypatch)
    texts = made_texts(5)
    check_words(windows.dedup(docs_of(texts), 9, 1).collect(), texts)


@pytest.mark.parametrize("most_contents", [10_000, 1])
def test_bytes_that_start_earlier_go(docs_of, monkeypatch, most_contents):
    small(monkeypatch)
    texts = made_texts(7)
    check_bytes(suffixes.dedup(docs_of(texts), BITS, 2, most_contents).collect(), texts)


def test_repeated_ids_null_ids_and_empty_tables(docs_of, spark, monkeypatch):
    small(monkeypatch)
    long = " ".join(f"w{k}" for k in range(60))
    texts = [(5, long), (5, long), (None, long), (2, "short"), (7, long), (5, long + " more")]
    docs = docs_of(texts).withColumn("kept", F.lit(1)).withColumn("row", F.lit(2)).withColumn("first", F.lit("x"))
    for dedup, per in ((windows.dedup, "n"), (suffixes.dedup, "n")):
        rows = dedup(docs, BITS).collect()
        assert len(rows) == 6
        gone = sorted((r["doc_id"], r[per] == r["n_removed"], r["n_removed"] > 0) for r in rows if r["doc_id"] is not None)
        assert gone == [(2, False, False), (5, False, False), (5, False, False), (5, False, False), (7, True, True)]
        assert dedup(docs.limit(0), BITS).count() == 0
    found = jaccard.join(docs, BITS)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"] or 0) for r in found.collect()) == [
        (False, 2, 2), (False, 5, 5), (False, 5, 5), (False, 5, 5), (False, 7, 5), (True, 0, 0)
    ]
    assert jaccard.join(docs.limit(0), BITS).count() == 0


@pytest.mark.parametrize("group_rows", [64, 2])
def test_jaccard_components(docs_of, monkeypatch, group_rows):
    small(monkeypatch)
    texts = made_texts(11)
    rows = jaccard.join(docs_of(texts), BITS, group_rows).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.components(texts)
    assert len(rows) == len(texts)


def test_a_chain_of_near_copies_is_one_component(docs_of, monkeypatch):
    """Ends of the chain do not link, so leaders alone do not find it."""
    small(monkeypatch)
    r = random.Random(1)
    words = [f"w{k}" for k in range(60)]
    texts = []
    for i in range(40):
        texts.append((i, " ".join(words)))
        k = r.randrange(1, 59)
        words[k] = f"n{i}"
    want = brute.components(texts)
    rows = jaccard.join(docs_of(texts), BITS, 4).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows} == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(0, k) for k in range(1, 50)]
    links = spark.createDataFrame(path + star + [(7, 7)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, **{k: 0 for k in range(50)}}
    assert components(links.limit(0)).count() == 0


def test_index_of_random_segments():
    r = np.random.default_rng(0)
    for _ in range(60):
        base = r.integers(0, 3, 200).astype(np.uint8)
        segments, docs = [], []
        for _ in range(r.integers(1, 20)):
            a, n = r.integers(0, 120), r.integers(50, 76)
            x = base[a : a + n].copy()
            if r.random() < 0.5:
                x[r.integers(0, len(x))] ^= 1
            segments.append(x)
            docs.append(int(r.integers(0, 8)))
        first = {}
        for x, d in zip(segments, docs, strict=True):
            for i in range(len(x) - 49):
                first[x[i : i + 50].tobytes()] = min(first.get(x[i : i + 50].tobytes(), 99), d)
        want = [i + 50 <= len(x) and first[x[i : i + 50].tobytes()] < d for x, d in zip(segments, docs, strict=True) for i in range(len(x))]
        got = suffixes.earlier(np.concatenate(segments), np.array([len(x) for x in segments]), np.array(docs))
        assert got.tolist() == want


def test_streams_that_are_not_in_the_index():
    """Matching statistics of strings that the index has in part, with symbols it lacks, or not at all."""
    r = np.random.default_rng(1)
    for _ in range(60):
        base = r.integers(0, 3, 200).astype(np.uint8)
        cut = lambda low: base[(a := r.integers(0, 120)) : a + r.integers(low, 81)].copy()
        held, docs = [cut(50) for _ in range(r.integers(1, 12))], r.integers(0, 8, 12)
        asked, ids = [cut(40) for _ in range(10)] + [np.full(60, 9, np.uint8)], r.integers(0, 12, 11)
        for x in asked[:5]:
            x[r.integers(0, len(x))] = r.integers(0, 6)
        first = {}
        for x, d in zip(held, docs[: len(held)].tolist(), strict=True):
            for i in range(len(x) - 49):
                first[x[i : i + 50].tobytes()] = min(first.get(x[i : i + 50].tobytes(), 99), d)
        want = [i + 50 <= len(x) and first.get(x[i : i + 50].tobytes(), 99) < d for x, d in zip(asked, ids, strict=True) for i in range(len(x))]
        sizes = lambda xs: np.array([len(x) for x in xs])
        index = suffixes.RunIndex(np.concatenate(held), sizes(held), docs[: len(held)])
        got = suffixes.streamed(index, np.concatenate(asked), sizes(asked), ids)
        assert got.tolist() == want


def test_a_line_repeated_very_often(docs_of, monkeypatch):
    """Places of a content are many, but it is indexed once a document."""
    small(monkeypatch)
    line = "one line of a licence that some text repeats again and again\n"
    other = "a text that has the line once: " + line + "and ends in words of its own, which stay"
    texts = [(1, line * 200_000), (2, other), (3, line[:-9] + "twice more\n" + line * 3)]
    rows = {r["doc_id"]: r for r in suffixes.dedup(docs_of(texts), BITS).collect()}
    assert {i: r["n"] for i, r in rows.items()} == {i: len(t) for i, t in texts}
    assert rows[1]["n_removed"] == 0 and rows[1]["n_spans"] == 0
    want = {i: (sum(gone), brute.runs_of(gone)) for i, _, gone in brute.removed_bytes([(1, line * 5)] + texts[1:])}
    assert all((rows[i]["n_removed"], rows[i]["n_spans"]) == want[i] for i in (2, 3))


def test_the_queries(spark, documents, sf_dir):
    texts = list(zip(documents.doc_id.tolist(), documents.text.tolist(), strict=True))
    rows = queries.QUERIES["op3_substring_dedup"](spark, sf_dir).collect()
    check_words([{"doc_id": r["doc_id"], "n": r["n_words"], "n_removed": r["n_removed"], "kept_sha": r["kept_sha256"]} for r in rows], texts)
    rows = queries.QUERIES["op6_jaccard_join"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.components(texts)
    rows = queries.QUERIES["op9_suffix_dedup"](spark, sf_dir).collect()
    check_bytes([{"doc_id": r["doc_id"], "n": r["n_bytes"], "n_removed": r["n_removed"], "n_spans": r["n_spans"], "kept_sha": r["kept_sha256"]} for r in rows], texts)


def test_sketches_of_any_slices_and_merging_tasks(spark):
    """Estimates are never below the counts; merging tasks grow with those that count."""
    import numpy as np

    from pigeonhole.llm import sketch

    def numbers(batches):
        for b in batches:
            yield (b.column("id").to_numpy() % 700).astype(np.uint64)

    df = spark.range(0, 3000, 1, 5)
    for bits, rows in ((9, 1), (20, 2)):
        built = sketch.build(df, numbers, bits, rows, (2, 5))
        times = np.bincount(np.arange(3000) % 700)
        for level, threshold in enumerate((2, 5)):
            assert built.at_least(np.arange(700, dtype=np.uint64), level)[times >= threshold].all()
        unseen = built.at_least(np.arange(10_000, 10_700, dtype=np.uint64))
        assert unseen.mean() < (0.001 if bits == 20 else 1.1)
    assert sketch.mergers(1, 2048) == 32 and sketch.mergers(300, 2048) == 600 and sketch.mergers(10**6, 2048) == 2048


def unlike_texts(count, words, seed):
    r = random.Random(seed)
    return [(k, " ".join(f"v{r.randrange(1 << 40)}" for _ in range(words))) for k in range(count)]


def test_texts_that_may_link_are_told_by_slice(docs_of, monkeypatch):
    """Every text that links is let through whatever the chunks, and texts of words of their own are not."""
    small(monkeypatch)
    monkeypatch.setattr(shared, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(shared, "CHUNK_TEXTS", 5)
    texts = made_texts(13) + unlike_texts(30, 60, 4)
    texts = [(k, t) for k, (_, t) in enumerate(texts)] + [(None, texts[0][1]), (None, "of no id " * 3)]
    docs = jaccard.texts(docs_of(texts))
    distinct = jaccard.DistinctTexts(docs, jaccard._plain, 1 << 20)
    rows = shared.judged(distinct, jaccard.token_sets, shared.text_bytes(docs)).collect()
    sets = {k: brute.shingles(t) for k, t in texts if k is not None}
    contents = {s: min(k for k in sets if sets[k] == s) for s in sets.values()}
    linked = {a for s, a in contents.items() if any(s is not u and 7 * len(s & u) >= 3 * (len(s) + len(u)) for u in contents if s and u)}
    live = {r["doc_id"] for r in rows if r["live"]}
    assert linked <= live and len(linked) > 10
    assert not live & set(range(len(texts) - 32, len(texts) - 2)) and None not in live
    assert sorted((r["n"] for r in rows if r["doc_id"] is None), reverse=True)[0] == len(brute.shingles(texts[-2][1]))
    assert all(r["n"] == len(sets[r["doc_id"]]) for r in rows if r["doc_id"] is not None)


def test_scratch_tables_of_a_crowded_sketch_stay_small(docs_of, spark, monkeypatch, tmp_path):
    """Sets are written of texts that may link only, however full the sketch is, and go when they have been used."""
    from pigeonhole.sources import files

    small(monkeypatch)
    most = []

    def held():
        return sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))

    def path(_, label):
        most.append(held())
        return f"file://{tmp_path}/{len(most)}-{label}"

    monkeypatch.setattr(files, "scratch_path", path)
    near = [(1_000 + k, " ".join(f"n{j}" for j in range(60) if j != 5 * k)) for k in range(4)]
    texts = unlike_texts(300, 400, 6) + near
    rows = jaccard.join(docs_of(texts), 9).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {k: min(k, 1_000) for k, _ in texts}
    assert max(most) < 0.2 * sum(len(t) for _, t in texts)
    assert held() < 0.1 * sum(len(t) for _, t in texts)


def test_tables_of_windows_go_when_used(docs_of, monkeypatch, tmp_path):
    """What decides single windows is deleted once the removed spans are written."""
    from pigeonhole.sources import files

    small(monkeypatch)
    count = iter(range(1_000))
    monkeypatch.setattr(files, "scratch_path", lambda _, label: f"file://{tmp_path}/{next(count)}-{label}")
    texts = made_texts(3)
    check_words(windows.dedup(docs_of(texts), BITS).collect(), texts)
    left = {p.name.partition("-")[2] for p in tmp_path.iterdir()}
    assert "judged" in left and not left & {"matched-runs", "open-spans", "windows", "repeated-windows"}
