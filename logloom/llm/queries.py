"""Thin queries over the synthetic tables, one per operator, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dart_minhash, hilbert_ann, html_paths, line_runs, merge_dropout, minimax_shards, packing, partial_distance, progressive_jpeg, token_cache, toxicity_cnn, word_runs, zstd_frames


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.extract_main_text(_table(spark, sf_dir, "pages"))


def op2_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progressive_jpeg.media_features(_table(spark, sf_dir, "documents"))


def op4_zstd_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_frames.token_files(_table(spark, sf_dir, "documents"))


def op5_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_cache.count_tokens(_table(spark, sf_dir, "documents"))


def op6_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encode_and_decode(_table(spark, sf_dir, "documents"))


def op7_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_runs.dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.classes(_table(spark, sf_dir, "documents"))


def op10_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digests(word_runs.word_runs(_table(spark, sf_dir, "documents"), plant=True))


def op12_partial_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partial_distance.cluster_rows(_table(spark, sf_dir, "embeddings"))


def op13_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards.shards_by_bytes(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_tag_paths, op2_toxicity_cnn, op3_progressive_jpeg, op4_zstd_frames, op5_token_cache, op6_merge_dropout, op7_swap_packing, op8_line_runs, op9_dart_minhash, op10_hilbert_ann, op11_word_runs, op12_partial_distance, op13_minimax_shards)
}

ORACLE_SQL = {
    "op8_line_runs": r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
    SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(f.first_doc <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN firsts f USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_partial_distance": r"""
WITH vectors AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v AS c FROM vectors ORDER BY sha256('1:' || vec_id) LIMIT 16
),
a0 AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d
    FROM (SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM vectors, c0) GROUP BY vec_id
), s0 AS MATERIALIZED (
    SELECT k, list(floor_mean ORDER BY p) AS c FROM (
        SELECT k, p, CASE WHEN sum(x) % count(*) < 0 THEN (sum(x) - sum(x) % count(*)) // count(*) - 1 ELSE (sum(x) - sum(x) % count(*)) // count(*) END::BIGINT AS floor_mean
        FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a0) GROUP BY k, p
    ) GROUP BY k
), c1 AS MATERIALIZED (
    SELECT k, coalesce(s0.c, c0.c) AS c FROM c0 LEFT JOIN s0 USING (k)
),
a1 AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d
    FROM (SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM vectors, c1) GROUP BY vec_id
), s1 AS MATERIALIZED (
    SELECT k, list(floor_mean ORDER BY p) AS c FROM (
        SELECT k, p, CASE WHEN sum(x) % count(*) < 0 THEN (sum(x) - sum(x) % count(*)) // count(*) - 1 ELSE (sum(x) - sum(x) % count(*)) // count(*) END::BIGINT AS floor_mean
        FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a1) GROUP BY k, p
    ) GROUP BY k
), c2 AS MATERIALIZED (
    SELECT k, coalesce(s1.c, c1.c) AS c FROM c1 LEFT JOIN s1 USING (k)
),
a2 AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d
    FROM (SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM vectors, c2) GROUP BY vec_id
), s2 AS MATERIALIZED (
    SELECT k, list(floor_mean ORDER BY p) AS c FROM (
        SELECT k, p, CASE WHEN sum(x) % count(*) < 0 THEN (sum(x) - sum(x) % count(*)) // count(*) - 1 ELSE (sum(x) - sum(x) % count(*)) // count(*) END::BIGINT AS floor_mean
        FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a2) GROUP BY k, p
    ) GROUP BY k
), c3 AS MATERIALIZED (
    SELECT k, coalesce(s2.c, c2.c) AS c FROM c2 LEFT JOIN s2 USING (k)
),
a3 AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d
    FROM (SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM vectors, c3) GROUP BY vec_id
)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (k)""",
}
