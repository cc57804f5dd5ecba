"""A pipeline over ``documents`` made of five operators of ``pigeonhole.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to
the shared folder and reads it back for the next. All but the last return the columns of
``documents``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pigeonhole.llm import jaccard, packing, quality, toxicity, windows
from pigeonhole.llm.features import dense
from pigeonhole.llm.queries import tokenizer
from pigeonhole.llm.tables import dropped, given, kept, remainder, settled, written

QUALITY_LEAST, TOXIC_LEAST = 0.5, 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as good; learns from the documents of the stage."""
    model = quality.fit(docs, given(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return kept(docs, lambda data, at: model.score(dense(data, at)) >= QUALITY_LEAST)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not score as toxic."""
    model = toxicity.fit(docs, given(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return kept(docs, lambda data, at: model.score(data, at) < TOXIC_LEAST)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of near duplicates; documents without words stay.

    Each row goes by its own text: it leaves if a row of a smaller id is in its component. Rows of
    one id are equal in rank, so none of them removes another, whether their texts are equal or not.
    """
    # Numbers of rows hold only once they are written.
    rows = settled(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    some = rows.where("doc_id is not null").select(F.col("_row").alias("doc_id"), "text")
    found = jaccard.join(some).select(F.col("doc_id").alias("_row"), "component_id")
    member = settled(found.join(rows.select("_row", "doc_id"), "_row"), "component-rows")
    ids = member.groupBy("component_id").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last"))
    ids = settled(ids.where("last > first_id").drop("last"), "component-firsts")
    later = settled(member.join(ids, "component_id").where("doc_id > first_id").select("_row"), "later-duplicates")
    dropped(member, ids)
    return rows.join(later, "_row", "left_anti").select(docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that an earlier document has.

    A changed text has its words joined by one space. Where rows of one id have different texts,
    each loses its own passages; rows of one id take none from each other.
    """
    found = windows.dedup(docs).where("kept is not null").groupBy("doc_id", "sha").agg(F.first("kept").alias("kept"))
    found = settled(found.select(F.col("doc_id").alias("_changed_id"), F.col("sha").alias("_changed_sha"), F.col("kept").alias("_kept")), "changed-texts")
    own = windows.with_sha(docs, "_sha")
    joined = own.join(found, (own["doc_id"] == found["_changed_id"]) & (own["_sha"] == found["_changed_sha"]), "left")
    new = {"text": F.coalesce("_kept", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_kept").isNotNull(), F.length("_kept").cast("bigint")).otherwise(F.col("n_chars"))
    return joined.select([new.get(c, F.col(c)).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids packed into sequences of up to 1024."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the classifiers; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
