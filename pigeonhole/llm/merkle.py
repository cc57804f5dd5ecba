"""A Merkle manifest of a table: leaves, one tree a source, one tree over the sources, proofs.

Every level of all trees is one table of nodes. A level is joined with itself by equality on the
indices of each node's siblings, which follow from its own index: 16 slots a run, so slot plus
offset modulo 16. Each node then has its run; the rows at slot zero emit the parents, and those
are the next level. All steps are DataFrame functions; levels shrink by 16, so a tree over n
leaves takes log16(n) joins, each over its own level only, and no run is larger than 16 nodes
whatever a source holds.

Digests are kept as 32 bytes and hashed as their 64 lowercase hex digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.columns import int_div
from pigeonhole.llm.ordering import group_key, ranked
from pigeonhole.llm.tables import configured, written

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Set to false, joins on more keys than their sides are dealt by need no further exchange.
BY_SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: Lower-cases A-Z and no other letter.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(of: Column) -> Column:
    """SHA-256 of a binary or text, as 32 bytes."""
    return F.unhex(F.sha2(of.cast("binary"), 256))


def as_hex(digests: Column) -> Column:
    """The lowercase hex text of one digest, or of several that lie on end."""
    return F.lower(F.hex(digests))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: each value as ``-`` if null, else byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _nothing() -> Column:
    return F.lit("").cast("binary")


def _joined(members: Column) -> Column:
    return F.aggregate(members, _nothing(), lambda all_, m: F.concat(all_, m["digest"]))


def siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """The nodes (tree, idx, n, digest and others) with ``left`` and ``right``, the digests of
    the run's nodes before and after them on end.

    Nodes are dealt by tree and run, which serves the join on sibling indices, the gathering of
    what it found and the way back to the node, if the session lets joins use a dealing by some
    of their keys (``BY_SOME_KEYS`` false).
    """
    placed = nodes.withColumn("run", int_div(F.col("idx"), arity)).repartition("tree", "run")
    offsets = F.explode(F.sequence(F.lit(0), F.lit(arity - 1))).alias("offset")
    asked = placed.select("tree", "run", "idx", "n", offsets)
    asked = asked.withColumn("sibling", F.col("run") * arity + (F.col("idx") + F.col("offset")) % arity).where("sibling < n")
    there = placed.select("tree", "run", F.col("idx").alias("sibling"), "digest")
    found = asked.select("tree", "run", "idx", "sibling").join(there, ["tree", "run", "sibling"])
    members = found.groupBy("tree", "run", "idx").agg(F.sort_array(F.collect_list(F.struct("sibling", "digest"))).alias("members"))
    members = members.select(
        "tree", "run", "idx",
        _joined(F.filter("members", lambda m: m["sibling"] < F.col("idx"))).alias("left"),
        _joined(F.filter("members", lambda m: m["sibling"] > F.col("idx"))).alias("right"),
    )
    return placed.join(members, ["tree", "run", "idx"])


def levels(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], list[DataFrame]]:
    """Of trees given by their leaves (tree, idx, n): the levels with siblings, and at each level
    the nodes of trees that end there (one more, as the last level has nothing but these)."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    found, ends = [], []
    while largest > 1:
        ends.append(nodes.where("n = 1"))
        with configured(nodes.sparkSession, BY_SOME_KEYS, "false"):
            found.append(written(siblings(nodes.where("n > 1"), arity), "tree-level"))
        first = found[-1].where(F.col("idx") % arity == 0)
        parent = digest(as_hex(F.concat(F.col("digest"), F.col("right"))))
        above = int_div(F.col("n") + (arity - 1), arity)
        nodes = first.select("tree", F.col("run").alias("idx"), above.alias("n"), parent.alias("digest"))
        largest = -(-largest // arity)
    return found, [*ends, nodes]


def paths(found: list[DataFrame], ends: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest level's rows with ``path``, the siblings from there to the end of all, lowest first.

    ``top`` has a row a tree: the columns to hand down, among them ``path`` above its own root.
    """
    handed = [c for c in top.columns if c not in ("tree", "path")]
    above = None
    for level, end in zip([*found, None][::-1], ends[::-1], strict=True):
        whole = end.join(top, "tree").drop("n", "digest")
        if level is not None:
            step = F.array(F.struct("left", "right"))
            parents = above.select("tree", F.col("idx").alias("run"), F.col("path").alias("_above"), *handed)
            inner = level.join(parents, ["tree", "run"]).withColumn("path", F.concat(step, "_above"))
            whole = inner.drop("run", "n", "digest", "left", "right", "_above").unionByName(whole)
        above = whole
    return above


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    Leaves ascend by doc_id within their source (null ids first, rows of one id by leaf); equal
    rows are leaves of their own. A run of one node still becomes a parent, but a tree of one
    leaf is its own root. ``tampered`` says of which rows the text has its A-Z lower-cased before
    the way to the root is recomputed from the untampered siblings; it is false where null.

    Null values are leaves as stated in :func:`leaf`; rows without a source form a tree of their
    own, the first. An empty table gives no rows. Other columns of the table, whatever their
    names, are left out.
    """
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    values = {c: F.col(c) for c in FIELDS}
    other = values | {"text": F.translate("text", UPPER, LOWER)}
    own = docs.select(
        "doc_id",
        group_key(F.col("source")).alias("tree"),
        leaf(list(values.values())).alias("digest"),
        F.when(changed, leaf(list(other.values()))).alias("altered"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("altered")]
    nodes = ranked(written(own, "leaves"), "tree", order)
    nodes = written(nodes.withColumnsRenamed({"rank": "idx", "members": "n"}).withColumn("leaf", F.col("digest")), "ranked-leaves")
    found, ends = levels(nodes, arity)
    ends = [ends[0].select(nodes.columns), *ends[1:]]

    subroots = [e.select("tree", F.col("digest").alias("subroot")) for e in ends]
    subroot = subroots[0]
    for more in subroots[1:]:
        subroot = subroot.unionByName(more)
    subroot = written(subroot, "subroots")
    crown = ranked(subroot.select(F.lit(0).alias("tree"), F.col("tree").alias("source_tree"), F.col("subroot").alias("digest")), "tree", [F.col("source_tree")])
    crown = written(crown.withColumnsRenamed({"rank": "idx", "members": "n"}).withColumn("subroot", F.col("digest")), "ranked-subroots")
    above, last = levels(crown, arity)
    # The last level of this one tree is the root, or there is no row at all.
    root = last[-1].select("tree", F.col("digest").alias("root"), F.array().cast("array<struct<left:binary,right:binary>>").alias("path"))
    top = paths(above, last, root).select(F.col("source_tree").alias("tree"), "subroot", "root", "path")

    rows = paths(found, ends, written(top, "source-paths"))
    proof = F.aggregate("path", _nothing(), lambda all_, p: F.concat(all_, p["left"], p["right"]))
    start = F.coalesce("altered", "leaf")
    folded = F.aggregate("path", start, lambda own_, p: digest(as_hex(F.concat(p["left"], own_, p["right"]))))
    rows = rows.select("doc_id", "leaf", "subroot", "root", "path", folded.alias("folded"))
    return rows.select(
        "doc_id",
        as_hex(F.col("leaf")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        F.sha2(as_hex(proof).cast("binary"), 256).alias("proof_sha256"),
        as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
