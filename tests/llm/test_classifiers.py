"""Operators 1, 5 and 7: held-out accuracy, and defined results for odd rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pigeonhole.llm import gam, language, quality, queries, samples, toxicity, trees
from pigeonhole.llm.tables import given, remainder

SF = "/root/testdata/sf0.01"


def auc(score, y):
    rank = pd.Series(score).rank().to_numpy()
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.98), ("op5_toxicity", "toxic", 0.75)])
def test_held_out_rows(spark, name, label, least):
    found = queries.QUERIES[name](spark, SF).toPandas()
    assert len(found) == len(pd.read_parquet(f"{SF}/documents.parquet")) and found.score.between(0, 1).all()
    rows = found.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    held = rows[rows.held_out]
    assert auc(held.score.to_numpy(), held[label].to_numpy()) > least
    assert (held.predicted == held[label]).mean() > 0.92


def test_language_of_held_out_rows(spark):
    found = queries.QUERIES["op7_language"](spark, SF).toPandas()
    rows = found.merge(pd.read_parquet(f"{SF}/documents.parquet", columns=["doc_id", "lang"]), on="doc_id")
    held = rows[rows.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97 and found.score.between(0, 1).all()


def test_languages_of_odd_texts(spark, docs_of):
    model = language.fit(given(spark, SF, "documents"), remainder("doc_id", 5) != 0)
    docs = docs_of([(1, None), (2, ""), (3, "123 !?"), (4, "the and of"), (4, "the and of"), (5, "日"), (6, "➤ ✓")])
    found = {(r["doc_id"], r["lang_pred"]) for r in language.predict(docs.withColumn("score", F.lit("x")), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (6, "und")} <= found
    assert all(p != "und" for i, p in found if i in (4, 5))
    nothing = language.fit(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_far_texts_are_rejected(spark, docs_of):
    model = language.fit(given(spark, SF, "documents"), remainder("doc_id", 5) != 0, furthest=0.05)
    assert language.predict(docs_of(["zzzz qqqq xxxx"]), model).first()["lang_pred"] == "und"


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_scores_of_odd_texts(spark, docs_of, kind):
    labels = given(spark, SF, "labels")
    model = kind.fit(given(spark, SF, "documents"), labels, F.lit(True))
    docs = docs_of([(1, None), (2, ""), (3, " \n"), (4, "!" * 9000), (5, "a"), (5, "a"), (None, "b")]).withColumn("y", F.lit("x"))
    found = kind.score(docs, model).collect()
    assert len(found) == 7 and all(0 <= r["score"] <= 1 for r in found)
    by = {r["doc_id"]: r["score"] for r in found}
    assert by[1] == by[2]
    assert kind.score(docs.limit(0), model).count() == 0
    unlearned = kind.fit(docs, labels.limit(0), F.lit(True))
    assert len({r["score"] for r in kind.score(docs, unlearned).collect()}) == 1


def test_additive_model_learns_a_crossing():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs and ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.85
    by_hand = np.full(5, model.intercept)
    for f in range(3):
        by_hand += model.tables[f][np.searchsorted(model.edges[f], x[:5, f])]
    for (a, b), t in zip(model.pairs, model.pair_tables, strict=True):
        by_hand += [t[np.searchsorted(model.coarse[a], v[a]), np.searchsorted(model.coarse[b], v[b])] for v in x[:5]]
    assert np.allclose(model.score(x[:5]), gam.sigmoid(by_hand))


def test_trees_and_calibration():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    forest = trees.fit(x[:2000], y[:2000])
    raw = forest.raw(x[2000:])
    assert ((raw > 0) == y[2000:]).mean() > 0.9
    xs, ys = trees.isotonic(raw, y[2000:])
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all()
    assert trees.isotonic(np.zeros(0), np.zeros(0))[1][0] == 0.5


# -- repeated ids ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def crowded(spark):
    """1,500 documents, a third of which have one id, and labels, 500 of which are of that id."""
    docs = given(spark, SF, "documents").where("doc_id < 1000").toPandas()
    docs = pd.concat([docs, docs.iloc[:500].assign(doc_id=7, text=docs.text[:500] + " again"), docs.iloc[:10].assign(doc_id=7, text="same")])
    labels = given(spark, SF, "labels").toPandas()
    labels = pd.concat([labels, pd.DataFrame({"doc_id": [7] * 500, "quality": [0, 1] * 250, "toxic": [1, 0] * 250})])
    return spark.createDataFrame(docs), spark.createDataFrame(labels)


def test_the_labelled_sample_is_bounded_by_rows(crowded):
    docs, labels = crowded
    rows = samples.labelled(docs, labels, "quality", F.lit(True)).collect()
    own = [(r["text"], r["y"]) for r in rows if r["doc_id"] == 7]
    texts = {r["text"] for r in docs.where("doc_id = 7").select("text").collect()}
    assert len(own) == len(texts) and {t for t, _ in own} == texts and {y for _, y in own} == {0}
    assert len({(r["doc_id"], r["text"]) for r in rows}) == len(rows)
    for bound in (1, 50):
        assert samples.labelled(docs, labels, "quality", F.lit(True), bound).count() <= bound


@pytest.mark.parametrize(("kind", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_learn_from_repeated_ids(crowded, monkeypatch, kind, label):
    docs, labels = crowded
    seen = []
    module = gam if kind is quality else trees
    learn = module.fit
    monkeypatch.setattr(module, "fit", lambda x, y, *more: seen.append(len(y)) or learn(x, y, *more))
    model = kind.fit(docs, labels, F.lit(True), 300)
    assert seen and max(seen) <= 300
    assert kind.score(docs, model).count() == docs.count()


def test_languages_keep_the_texts_of_their_rows(spark, crowded):
    docs, _ = crowded
    model = language.fit(docs, F.lit(True))
    whole = given(spark, SF, "documents")
    found = language.predict(whole, model).join(whole.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred = lang").count() / found.count() > 0.97
    # One id for all rows, in two languages: 400 rows and no more are looked at.
    one = spark.createDataFrame([(1, f"the cat and dog {i}" if i % 2 else f"der hund und katze {i}", "en" if i % 2 else "de") for i in range(400)], "doc_id bigint, text string, lang string")
    model = language.fit(one, F.lit(True))
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(spark.createDataFrame([(1, "the dog and cat"), (2, "die katze und hund")], "doc_id bigint, text string"), model).collect()}
    assert got == {1: "en", 2: "de"}
