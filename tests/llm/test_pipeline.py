"""The pipeline's stages, each on what its predecessor kept."""

import brute
import pandas as pd
import pytest
import test_tokens
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline as pipeline
from pigeonhole.llm import queries
from pigeonhole.llm.tables import given, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = given(spark, sf_dir, "documents"), {}
    out["start"] = docs.toPandas()
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        out[name] = docs.toPandas()
    return out


def test_each_stage_keeps_columns(stages):
    for name in ("quality", "toxicity", "near_duplicates", "substring_dedup"):
        assert list(stages[name].columns) == COLUMNS


def test_filters_go_by_the_classifiers(stages, spark, sf_dir):
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet").set_index("doc_id")
    kept = stages["quality"][stages["quality"].doc_id.isin(labels.index)].doc_id
    assert labels.loc[kept].quality.mean() > 0.95
    good = labels[labels.quality == 1].index
    assert len(set(good) - set(stages["quality"].doc_id)) <= 2
    clean = labels[(labels.quality == 1) & (labels.toxic == 0)].index
    assert len(set(clean) - set(stages["toxicity"].doc_id)) <= 3


def test_one_document_of_a_group_stays(stages):
    before = stages["toxicity"]
    parts = brute.components(zip(before.doc_id.tolist(), before.text.tolist(), strict=True))
    want = {c for _, c in parts.values()}
    assert set(stages["near_duplicates"].doc_id) == want


def test_substrings_go(stages):
    before = stages["near_duplicates"]
    after = stages["substring_dedup"].set_index("doc_id")
    for i, words, gone in brute.removed_words(zip(before.doc_id.tolist(), before.text.tolist(), strict=True)):
        if any(gone):
            left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
            assert after.text[i] == left and after.n_chars[i] == len(left)
        else:
            assert after.text[i] == before.set_index("doc_id").text[i]


def test_packing(stages):
    before = stages["substring_dedup"]
    rows = stages["packing"].to_dict("records")
    test_tokens.check_packing(rows, list(zip(before.doc_id.tolist(), before.text.tolist(), strict=True)))


def test_stages_on_odd_tables(spark, sf_dir, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "a b c"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "A b c d e f")])
    docs = docs.withColumn("kept", F.lit("x")).withColumn("score", F.lit(1)).withColumn("component_id", F.lit(9))
    for k, (_, stage) in enumerate(pipeline.STAGES):
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        if k < 4:
            assert stage(spark, docs, sf_dir).columns == docs.columns
    kept = pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 2, 3, 3]


def test_rows_of_one_id_go_by_their_own_texts(spark, sf_dir, docs_of):
    passage, other, own = (" ".join(f"{w}{i}" for i in range(60)) for w in "pqr")
    docs = [(1, passage), (2, f"{passage} a"), (2, other), (2, other), (3, f"{other} b"), (4, f"{own} c"), (4, f"{own} d"), (None, passage)]
    want = [(1, passage), (2, other), (2, other), (4, f"{own} c"), (4, f"{own} d"), (None, passage)]
    rows = pipeline.near_duplicate_stage(spark, docs_of(docs), sf_dir).collect()
    assert sorted((r["doc_id"] or 9, r["text"]) for r in rows) == sorted((i or 9, t) for i, t in want)
    docs = [(1, passage), (2, f"x  y {passage} z"), (2, f"k {passage}"), (2, f"{own}\tw"), (2, passage), (2, f"{own} {own}"), (3, f"{own} v")]
    want = [(1, passage), (2, "x y z"), (2, "k"), (2, f"{own}\tw"), (2, ""), (2, f"{own} {own}"), (3, "v")]
    rows = pipeline.substring_stage(spark, docs_of(docs), sf_dir).collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_registered(spark):
    named = entry_module.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(named)
    for n in range(1, 11):
        assert len([q for q in named if q.startswith(f"op{n}_")]) == 1
    assert set(queries.ORACLES) <= set(entry_module.oracle_sql())


def test_sql_of_top_k(spark, sf_dir):
    from compare import connect

    found = connect(sf_dir).execute(queries.ORACLES["op4_top_k"]).df()
    rows = queries.QUERIES["op4_top_k"](spark, sf_dir).toPandas()
    key = ["query_id", "rank"]
    assert found.sort_values(key)[[*key, "vec_id", "score"]].to_numpy().tolist() == rows.sort_values(key)[[*key, "vec_id", "score"]].to_numpy().tolist()


def test_near_duplicates_need_little_disk_with_a_crowded_sketch(spark, docs_of, monkeypatch, tmp_path):
    """Beside the numbered rows, scratch tables stay small where the sketch is full."""
    import random
    from functools import partial

    from pigeonhole.llm import jaccard
    from pigeonhole.sources import files

    sizes = []

    def held():
        return sum(p.stat().st_size for p in tmp_path.rglob("*.parquet") if "numbered-rows" not in str(p))

    def path(_, label):
        sizes.append(held())
        return f"file://{tmp_path}/{len(sizes)}-{label}"

    monkeypatch.setattr(files, "scratch_path", path)
    monkeypatch.setattr(jaccard, "join", partial(jaccard.join, bits=9))
    r = random.Random(6)
    texts = [(k, " ".join(f"v{r.randrange(1 << 40)}" for _ in range(400))) for k in range(300)]
    texts += [(1_000 + k, " ".join(f"n{j}" for j in range(60) if j != 5 * k)) for k in range(4)]
    rows = pipeline.near_duplicate_stage(spark, docs_of(texts), "").collect()
    assert sorted(x["doc_id"] for x in rows) == [*range(300), 1_000]
    assert max(sizes) < 0.2 * sum(len(t) for _, t in texts)
