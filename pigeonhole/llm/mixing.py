"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Sources share the words of the whole corpus by weight, up to ``most`` times their own size.
Within a source the documents stand in a row, largest first, each as long as the number of
copies it is expected to give; a copy is taken wherever the running length, moved by one random
offset of the source, crosses an integer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.ordering import group_key, ranked
from pigeonhole.llm.tables import written

#: A word is a run of bytes other than blank and 0x09 to 0x0D.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Expected copies are counted in this part of a copy, so that sums of them are exact.
UNIT = 1 << 31


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``source_key, source, source_size`` with the ``target`` of each source.

    The sources, by code point with null last, weigh ``weights`` over and over. Those whose share
    is above ``most`` times their size stop there, and the others share what is left; each round
    is one aggregate over the sources, until none is above.
    """
    placed = ranked(sources.withColumn("_all", F.lit(0)), "_all", [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    placed = placed.select("source_key", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("ceiling"))
    share, stopped = 0.0, -1
    while True:
        above = F.col("ceiling").cast("double") < F.lit(share) * F.col("weight")
        row = placed.agg(
            F.sum("source_size").alias("whole"),
            F.count_if(above).alias("stopped"),
            F.sum(F.when(above, F.col("ceiling"))).alias("used"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if row["stopped"] == stopped or not row["open"]:
            break
        stopped, share = row["stopped"], ((row["whole"] or 0) - (row["used"] or 0)) / row["open"]
    target = F.least(F.col("ceiling").cast("double"), F.lit(share) * F.col("weight"))
    return placed.select("source_key", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, seed: int = 0) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` of every document.

    ``size`` counts words, ``target`` is the source's, ``copies`` how often the mix takes the
    document and ``taken`` the words of these copies. A document gives the two whole numbers of
    copies around target / source_size, so ``most`` at most. As the largest come first, the
    words taken from a source are off its target by less than the size of its largest document.
    The offset follows from ``seed`` and the source, so reruns agree, on any number of partitions.

    Every document of a source is expected to give equally many copies, so the prefix sum before
    the one at rank r is r times that; it is computed in whole units, of which only the remainder
    by a copy matters. A source may hold any share of the rows: it is ranked over many tasks.

    Null and empty texts, and texts of blanks, have size 0 and give nothing. Documents without a
    source form a source of their own, the last. Repeated ids and rows are documents of their own.
    An empty table gives no rows. Other columns, whatever their names, are left out.
    """
    sized = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sized = written(sized.withColumn("source_key", group_key(F.col("source"))), "sized-documents")
    sources = written(sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size")), "sources")
    target = written(targets(sources, weights, most), "targets")

    start = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}"), F.col("source_key")), 256), 1, 8), 16, 10).cast("bigint") % UNIT
    expected = F.floor(F.try_divide(F.col("target") * F.lit(float(UNIT)), F.col("source_size"))).cast("bigint")
    # A source of size 0 has no rate and gives nothing.
    expected = F.when(expected.isNull(), F.lit(0).cast("bigint")).otherwise(F.least(expected, F.lit(most * UNIT)))
    target = target.withColumn("_start", start).withColumn("_expected", expected)

    # Whole units: both factors stay below 2^31, so the product fits.
    rest = F.col("_expected") % UNIT
    before = ((F.col("rank") % UNIT) * rest + F.col("_start")) % UNIT
    crossed = F.call_function("div", before + F.col("_expected"), F.lit(UNIT).cast("bigint"))
    rows = ranked(sized.drop("source"), "source_key", [F.col("size").desc(), F.col("doc_id").asc_nulls_first()])
    return rows.join(target, "source_key").select(
        "doc_id", "size", "source_size", "target", crossed.alias("copies"), (crossed * F.col("size")).alias("taken")
    )
