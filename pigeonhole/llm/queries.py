"""The registered queries of this package: each operator with production parameters on its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pigeonhole.llm import jaccard, language, merkle, mixing, nearest, packing, periodic, quality, sentencepieces, suffixes, topk, toxicity, windows
from pigeonhole.llm.tables import given, remainder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """Where the public vocabulary file of that name is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark, sf_dir):
    docs, rest = given(spark, sf_dir, "documents"), remainder("doc_id", 3)
    model = quality.fit(docs, given(spark, sf_dir, "labels"), rest != 1)
    return quality.score(docs, model).select(
        "doc_id",
        (rest == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op2_sentencepiece(spark, sf_dir):
    path = tokenizer("piece_bpe_32k.model")
    decoded = sentencepieces.decode(sentencepieces.encode(given(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_substring_dedup(spark, sf_dir):
    return windows.dedup(given(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_words"), "n_removed", F.col("kept_sha").alias("kept_sha256")
    )


def op4_top_k(spark, sf_dir):
    return topk.top_k(given(spark, sf_dir, "embeddings"))


def op5_toxicity(spark, sf_dir):
    docs, rest = given(spark, sf_dir, "documents"), remainder("doc_id", 4)
    model = toxicity.fit(docs, given(spark, sf_dir, "labels"), rest != 2)
    return toxicity.score(docs, model).select(
        "doc_id",
        (rest == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op6_jaccard_join(spark, sf_dir):
    return jaccard.join(given(spark, sf_dir, "documents"))


def op7_language(spark, sf_dir):
    docs, rest = given(spark, sf_dir, "documents"), remainder("doc_id", 5)
    found = language.predict(docs, language.fit(docs, rest != 0))
    return found.select("doc_id", (rest == 0).alias("held_out"), "lang_pred", "score")


def op8_nearest(spark, sf_dir):
    return nearest.nearest(given(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark, sf_dir):
    return suffixes.dedup(given(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.col("kept_sha").alias("kept_sha256")
    )


def op10_packing(spark, sf_dir):
    return packing.pack(given(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_merkle(spark, sf_dir):
    return merkle.manifest(given(spark, sf_dir, "documents"), remainder("doc_id", 5) == 0)


def _planted(doc_id: int, n: int) -> tuple[int, int] | None:
    """The repeats that the query writes into every tenth text."""
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    return None if rest else (g % n, 1 + (n - g % n) // (3 + g % 8))


def op12_periodic_runs(spark, sf_dir):
    found = periodic.collapse(given(spark, sf_dir, "documents"), _planted)
    by_exponent = F.transform("runs", lambda r: F.struct((-(r["length"] / r["period"])).alias("e"), r["start"], r["period"], r["length"]))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", F.array_min(by_exponent))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_sentencepiece,
        op3_substring_dedup,
        op4_top_k,
        op5_toxicity,
        op6_jaccard_join,
        op7_language,
        op8_nearest,
        op9_suffix_dedup,
        op10_packing,
        op11_merkle,
        op12_periodic_runs,
        op13_mixing,
    )
}
ORACLES: dict[str, str] = {
    "op4_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
            from embeddings
            where embedding is not null
              and list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)::int), 'min') = 1
        )
        select q.vec_id as query_id, r.rank::int as rank, r.vec_id, r.score::bigint as score
        from (select * from v where vec_id % 100 = 0) q,
        lateral (
            select c.vec_id, s.score, row_number() over (order by s.score desc, c.vec_id) as rank
            from v c, lateral (select list_inner_product(q.v, c.v) as score) s
            where c.vec_id <> q.vec_id
            qualify rank <= 10
        ) r
    """,
    "op11_merkle": r"""
        with recursive leaves as (
            select doc_id, source, coalesce(':' || source, '') as tree,
                   sha256(concat(
                       coalesce(strlen(doc_id::text) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::text) || ':' || n_chars, '-'),
                       coalesce(strlen(text) || ':' || text, '-'))) as leaf,
                   sha256(concat(
                       coalesce(strlen(doc_id::text) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::text) || ':' || n_chars, '-'),
                       coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))) as lower_leaf,
                   xor(4294967295, list_reduce(
                       list_prepend(4294967295::bigint, list_transform(string_split(doc_id::text, ''), lambda c: ord(c)::bigint)),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                                                lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) % 5 = 0 as changed
            from documents
        ),
        numbered as (
            select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n
            from leaves
        ),
        lower_tree as (
            select 0 as lvl, tree, idx, n, leaf as digest from numbered
            union all
            select lvl + 1, tree, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx))
            from lower_tree where n > 1 group by lvl, tree, idx // 16, (n + 15) // 16
        ),
        subroots as (
            select tree, digest as subroot, row_number() over (order by tree) - 1 as idx, count(*) over () as n from lower_tree where n = 1
        ),
        upper_tree as (
            select 0 as lvl, idx, n, subroot as digest from subroots
            union all
            select lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx))
            from upper_tree where n > 1 group by lvl, idx // 16, (n + 15) // 16
        ),
        lower_proof as (
            select doc_id, tree, idx as place, 0 as lvl, idx, n, leaf as own, ''::text as proof,
                   case when changed then lower_leaf else leaf end as folded
            from numbered
            union all
            select p.doc_id, p.tree, p.place, p.lvl + 1, p.idx // 16, (p.n + 15) // 16, p.own, p.proof || r.left || r.right, sha256(r.left || p.folded || r.right)
            from lower_proof p join (
                select t.lvl, t.tree, t.idx,
                       coalesce(string_agg(s.digest, '' order by s.idx) filter (s.idx < t.idx), '') as left,
                       coalesce(string_agg(s.digest, '' order by s.idx) filter (s.idx > t.idx), '') as right
                from lower_tree t join lower_tree s on s.lvl = t.lvl and s.tree = t.tree and s.idx // 16 = t.idx // 16
                where t.n > 1 group by t.lvl, t.tree, t.idx
            ) r on r.lvl = p.lvl and r.tree = p.tree and r.idx = p.idx
        ),
        upper_proof as (
            select p.doc_id, p.tree, p.place, p.own, s.subroot, 0 as lvl, s.idx, s.n, p.proof, p.folded
            from lower_proof p join subroots s using (tree) where p.n = 1
            union all
            select p.doc_id, p.tree, p.place, p.own, p.subroot, p.lvl + 1, p.idx // 16, (p.n + 15) // 16, p.proof || r.left || r.right, sha256(r.left || p.folded || r.right)
            from upper_proof p join (
                select t.lvl, t.idx,
                       coalesce(string_agg(s.digest, '' order by s.idx) filter (s.idx < t.idx), '') as left,
                       coalesce(string_agg(s.digest, '' order by s.idx) filter (s.idx > t.idx), '') as right
                from upper_tree t join upper_tree s on s.lvl = t.lvl and s.idx // 16 = t.idx // 16
                where t.n > 1 group by t.lvl, t.idx
            ) r on r.lvl = p.lvl and r.idx = p.idx
        )
        select p.doc_id, p.own as leaf, p.subroot, u.digest as root, sha256(p.proof) as proof_sha256, p.folded as folded_root, p.folded = u.digest as verified
        from upper_proof p, upper_tree u where p.n = 1 and u.n = 1
    """,
    "op13_mixing": r"""
        with sized as (
            select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
            from documents
        ),
        placed as (
            select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as ceiling,
                   [5, 2, 1][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as weight
            from sized group by source
        ),
        filled as (
            select
                   (sum(source_size) over () - coalesce(sum(ceiling) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as share
            from placed
            window before as (order by ceiling / weight, source rows between unbounded preceding and 1 preceding)
        ),
        targets as (
            select source, source_size, least(ceiling::double, weight * (select max(share) from filled)) as target,
                   ('0x' || substr(sha256('0' || coalesce(':' || source, '')), 1, 8))::bigint % 2147483648 as start
            from placed
        ),
        ranked as (
            select s.doc_id, s.size, t.*, coalesce(floor(t.target * 2147483648.0::double / nullif(t.source_size, 0)), 0)::bigint as expected,
                   row_number() over (partition by s.source order by s.size desc, s.doc_id nulls first) - 1 as rank
            from sized s join targets t on s.source is not distinct from t.source
        )
        select doc_id, size, source_size, target,
               (((rank * expected::hugeint + start) % 2147483648 + expected) // 2147483648 * size)::bigint as taken
        from ranked
    """,
}
