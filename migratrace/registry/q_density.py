"""Density clustering over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from migratrace.functions.columns import half_even
from migratrace.operators.density import (
    blocked_points,
    cluster_params,
    count_copies,
    density_clusters,
    density_cut,
    vector_points,
    with_core,
)
from migratrace.operators.spanning import candidate_edges, spanning_tree
from migratrace.registry.tickets import table

_SAMPLES = 4
_EPS = 1.17
_MIN_SIZE = 12


def _cored(spark, folder):
    distinct, _ = count_copies(vector_points(table(spark, folder, "embeddings"), "vec_id", "embedding"))
    placed, cells = blocked_points(distinct, distinct.count())
    return with_core(placed, cells, _SAMPLES), cells


def adaptive_parameters(spark, folder):
    """The parameters that follow from the number of vectors."""
    rows = table(spark, folder, "embeddings").count()
    size, samples = cluster_params(rows)
    return table(spark, folder, "embeddings").groupBy().agg(
        F.count(F.lit(1)).alias("rows"), F.lit(size).alias("min_cluster_size"), F.lit(samples).alias("min_samples")
    )


def core_distance(spark, folder):
    cored, _ = _cored(spark, folder)
    return cored.select(F.col("id").alias("vec_id"), half_even(F.col("core"), 6).alias("core"))


def spanning_weight(spark, folder):
    """Edges, total and heaviest weight of the spanning tree under mutual reachability."""
    cored, cells = _cored(spark, folder)
    return spanning_tree(candidate_edges(cored, cells)).agg(
        F.count(F.lit(1)).alias("edges"), half_even(F.sum("w"), 4).alias("total"), half_even(F.max("w"), 6).alias("widest")
    )


def density_cut_query(spark, folder):
    cored, cells = _cored(spark, folder)
    cut = density_cut(cored, spanning_tree(candidate_edges(cored, cells)), _EPS, _MIN_SIZE)
    return cut.select(F.col("id").alias("vec_id"), F.col("first").alias("first_vec"))


def density_clusters_query(spark, folder):
    return density_clusters(table(spark, folder, "embeddings"), "vec_id", "embedding").select("vec_id", "Cluster_ID")


QUERIES = {
    "adaptive_parameters": adaptive_parameters,
    "core_distance": core_distance,
    "spanning_weight": spanning_weight,
    "density_cut": density_cut_query,
    "density_clusters": density_clusters_query,
}

_PAIRS = """
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b,
    list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
  FROM embeddings a, embeddings b
)"""
_CORES = f"""
cores AS (
  SELECT a AS id, max(d) AS core FROM (
    SELECT a, d FROM pairs QUALIFY row_number() OVER (PARTITION BY a ORDER BY d, b) <= {_SAMPLES}) GROUP BY 1
)"""

# the tree grown from the first of the distinct vectors: per step the reach of every vector that is not in it yet
_TREE = """
points AS (SELECT min(vec_id) AS id FROM embeddings GROUP BY embedding),
reach AS MATERIALIZED (
  SELECT p.a, p.b, greatest(p.d, x.core, y.core) AS w FROM pairs p
  JOIN cores x ON x.id = p.a JOIN cores y ON y.id = p.b
  WHERE p.a <> p.b AND p.a IN (SELECT id FROM points) AND p.b IN (SELECT id FROM points)
),
grown(step, v, w) AS (
  SELECT 1, b, w FROM reach WHERE a = (SELECT min(id) FROM points)
  UNION ALL
  SELECT step + 1, v, least(g.w, r.w) FROM grown g JOIN reach r ON r.b = g.v WHERE r.a = (SELECT arg_min(v, w) FROM grown)
),
tree AS (SELECT step, min(w) AS w FROM grown GROUP BY 1)"""

SQL = {
    "spanning_weight": f"""WITH RECURSIVE {_PAIRS}, {_CORES}, {_TREE}
SELECT count(*) AS edges, round_even(sum(w) * 1e4, 0) / 1e4 AS total, round_even(max(w) * 1e6, 0) / 1e6 AS widest FROM tree""",
    "adaptive_parameters": """SELECT count(*) AS "rows",
        CAST(CASE WHEN count(*) < 300 THEN 5 WHEN count(*) < 2000 THEN 12 WHEN count(*) < 10000 THEN 30 ELSE 50 END AS INTEGER) AS min_cluster_size,
        CAST(CASE WHEN count(*) < 300 THEN 2 WHEN count(*) < 2000 THEN 4 WHEN count(*) < 10000 THEN 10 ELSE 15 END AS INTEGER) AS min_samples
        FROM embeddings""",
    "core_distance": f"WITH {_PAIRS}, {_CORES} SELECT id AS vec_id, round_even(core * 1e6, 0) / 1e6 AS core FROM cores",
    "density_cut": f"""WITH RECURSIVE {_PAIRS}, {_CORES},
links AS MATERIALIZED (
  SELECT p.a, p.b FROM pairs p JOIN cores x ON x.id = p.a JOIN cores y ON y.id = p.b
  WHERE greatest(p.d, x.core, y.core) <= {_EPS}
),
reached(start, v) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.start, l.b FROM reached r JOIN links l ON l.a = r.v
),
grouped AS (SELECT start, count(*) AS n, min(v) AS first_vec FROM reached GROUP BY 1)
SELECT start AS vec_id, CASE WHEN n >= {_MIN_SIZE} THEN first_vec END AS first_vec FROM grouped""",
}
