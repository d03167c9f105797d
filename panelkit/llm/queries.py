"""Registered queries of the operators, each over its whole table, and SQL where a second engine can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import ann, centroids, decontaminate, hard_negatives, licenses, line_dedup, lm_score, packing, pii, simhash, substring_dedup, suffix_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_query
def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(_table(spark, sf_dir, "documents")))


@_query
def op8_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query
def op7_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


@_query
def op2_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: Word shingles of both tables, joined as text; the words are those of hashing.WORD_BYTES.
_SHINGLES = """
    SELECT DISTINCT id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS s
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
          FROM (SELECT {id} AS id, list_filter(string_split(regexp_replace(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' '),
                lambda x: x <> '') AS w
                FROM {table}) WHERE len(w) > 0)"""

ORACLE["op2_benchmark_containment"] = f"""
    WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
         b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
         n AS (SELECT id, count(*) AS n FROM b GROUP BY id)
    SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared, any_value(n.n) AS n_shingles,
           count(*)::DOUBLE / any_value(n.n) AS containment
    FROM d JOIN b ON d.s = b.s AND (length(d.s) - length(replace(d.s, ' ', ''))) = (length(b.s) - length(replace(b.s, ' ', '')))
    JOIN n ON n.id = b.id GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(n.n)"""


@_query
def op10_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE["op10_one_bit_neighbours"] = """
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
         p AS (SELECT q.vec_id AS query_id, e.vec_id, sqrt(list_sum(list_transform(range(1, len(q.v) + 1),
                          lambda i: (e.v[i] - q.v[i]) * (e.v[i] - q.v[i])))) AS score
               FROM e AS q JOIN e ON q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id AND len(q.v) = len(e.v)),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM p)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"))


ORACLE["op5_line_dedup"] = """
    WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
         l AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, trim(unnest(ls), ' ') AS t FROM s),
         d AS (SELECT t, min((doc_id, line_no)) AS place, string_split(t, ' ') AS w FROM l WHERE t <> '' GROUP BY t),
         v AS (SELECT t, place, len(w) AS n, i, md5(array_to_string(w[1 : i - 1] || w[i + 1 :], ' ')) AS rest
               FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= 10)),
         c AS (SELECT t, place, length(t) AS n, i, md5(substr(t, 1, i - 1) || substr(t, i + 1)) AS rest
               FROM (SELECT *, unnest(range(1, length(t) + 1)) AS i FROM d WHERE len(w) < 10 AND length(t) >= 5)),
         near AS (SELECT a.t FROM v a JOIN v b ON a.n = b.n AND a.i = b.i AND a.rest = b.rest AND b.place < a.place
                  UNION SELECT a.t FROM v a JOIN d b ON a.n = len(b.w) + 1 AND len(b.w) >= 10 AND a.rest = md5(b.t) AND b.place < a.place
                  UNION SELECT b.t FROM v a JOIN d b ON a.n = len(b.w) + 1 AND len(b.w) >= 10 AND a.rest = md5(b.t) AND a.place < b.place
                  UNION SELECT a.t FROM c a JOIN c b ON a.n = b.n AND a.i = b.i AND a.rest = b.rest AND b.place < a.place
                  UNION SELECT a.t FROM c a JOIN d b ON a.n = length(b.t) + 1 AND length(b.t) >= 5 AND len(b.w) < 10 AND a.rest = md5(b.t) AND b.place < a.place
                  UNION SELECT b.t FROM c a JOIN d b ON a.n = length(b.t) + 1 AND length(b.t) >= 5 AND len(b.w) < 10 AND a.rest = md5(b.t) AND a.place < b.place),
         g AS (SELECT l.doc_id, l.line_no FROM l JOIN d ON l.t = d.t
               WHERE (l.doc_id, l.line_no) <> d.place OR d.t IN (SELECT t FROM near))
    SELECT s.doc_id, len(s.ls)::BIGINT AS n_lines, count(g.line_no)::BIGINT AS n_removed,
           coalesce(string_agg(g.line_no::VARCHAR, ',' ORDER BY g.line_no), '') AS removed_lines
    FROM s LEFT JOIN g ON s.doc_id = g.doc_id GROUP BY s.doc_id, s.ls"""


@_query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


@_query
def op4_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(_table(spark, sf_dir, "documents"), good)


@_query
def op12_incremental_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings")).drop("centroid")


def _centroid_rounds(rounds: int) -> str:
    """Rounds of assignment and floor means, each a pair of named queries; x % n has the sign of x."""
    parts = []
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (
                SELECT row, min((d, k)) AS m FROM (SELECT row, k, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{n} USING (i) GROUP BY row, k) GROUP BY row)"""
        )
        if n < rounds:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (
                SELECT k, i, coalesce(s.mean, c{n}.c) AS c FROM c{n} LEFT JOIN (
                    SELECT k, i, (t - (t % n + n) % n) // n AS mean
                    FROM (SELECT m[2] AS k, i, sum(x)::BIGINT AS t, count(*)::BIGINT AS n FROM a{n} JOIN x USING (row) GROUP BY ALL)) AS s USING (k, i))"""
            )
    return ",\n".join(parts)


ORACLE["op12_incremental_centroids"] = f"""
    WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id,
                                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
                            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         x AS MATERIALIZED (SELECT row, unnest(range(64)) AS i, unnest(v) AS x FROM e),
         c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS i, unnest(v) AS c
                             FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, v FROM e) WHERE k < 8),
         {_centroid_rounds(10)},
         h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY k)
    SELECT vec_id, m[2]::INTEGER AS cluster, m[1] AS distance, sum(m[1]) OVER (PARTITION BY m[2])::BIGINT AS cluster_inertia,
           sum(m[1]) OVER ()::BIGINT AS inertia, centroid_sha256
    FROM a10 JOIN e USING (row) JOIN h ON k = m[2]"""


@_query
def op11_angular_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE["op11_angular_hard_negatives"] = """
    WITH e AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS MATERIALIZED (
              SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id,
                     list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * e.v[i]))::BIGINT AS score
              FROM e AS a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id AND len(a.v) = len(e.v)),
         p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
               QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5"""


@_query
def op13_fm_index_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))
