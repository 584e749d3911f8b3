"""Retrieval over embeddings, documents and conversations."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import functions as F

from migratrace.functions.columns import half_even
from migratrace.operators.embed import embed
from migratrace.operators.retrieve import (
    ANSWER_TASK,
    resolution_prompts,
    resolve_tickets,
    retrieve_tickets,
    top_k_similar,
)
from migratrace.operators.vector_index import VectorIndex, recall
from migratrace.registry.tickets import table
from migratrace.session import materialize, own_folder

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_encoder():
    def encode(texts: Sequence[str]) -> np.ndarray:
        return np.array([[t.count(c) for c in _LETTERS] for t in texts], dtype=np.float32)

    return encode


def echo_generator():
    return lambda prompt, max_tokens: f"{len(prompt)} characters, at most {max_tokens} tokens"


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("Embedding"))


def _rounded(found):
    return found.withColumn("Similarity", half_even(F.col("Similarity"), 6))


def similar_topk(spark, folder):
    """Every vector against all vectors."""
    vectors = _vectors(spark, folder)
    return _rounded(top_k_similar(vectors.withColumnRenamed("vec_id", "Query_ID"), vectors, key="vec_id"))


def similar_topk_blocked(spark, folder):
    """The same through block pairs, as for more queries than fit every task."""
    vectors = _vectors(spark, folder)
    queries = vectors.withColumnRenamed("vec_id", "Query_ID")
    return _rounded(top_k_similar(queries, vectors, key="vec_id", shipped_values=0, per_block=128))


def similar_topk_nan(spark, folder):
    """Vectors with a NaN, an infinite or a missing component take no part, on either side and in either plan."""
    bad = F.when(F.col("vec_id") % 7 == 0, F.lit(float("nan"))).when(F.col("vec_id") % 7 == 1, F.lit(float("inf")))
    broken = F.when(F.col("vec_id") % 7 < 3, F.concat(F.array(bad.cast("float")), F.slice("Embedding", 2, 10_000))).otherwise(F.col("Embedding"))
    vectors = _vectors(spark, folder).withColumn("Embedding", broken)
    queries = vectors.withColumnRenamed("vec_id", "Query_ID")
    found = top_k_similar(queries, vectors, key="vec_id")
    blocks = top_k_similar(queries, vectors, key="vec_id", shipped_values=0, per_block=128)
    both = found.join(blocks, ["Query_ID", "vec_id", "Similarity", "Rank"], "full_outer")
    return both.select("Query_ID", "vec_id", "Rank")


def _index(spark, folder):
    """Two thirds of the vectors as the first batch, the rest appended."""
    vectors = _vectors(spark, folder)
    place = f"{own_folder(spark)}/vector-index-{uuid.uuid4().hex}"
    VectorIndex.build(vectors.where("vec_id % 3 <> 0"), place, "vec_id", per_block=32).append(vectors.where("vec_id % 3 = 0"), "vec_id")
    return vectors.withColumnRenamed("vec_id", "Query_ID"), VectorIndex(spark, place, per_block=32)


def similar_topk_indexed(spark, folder):
    """Every vector against an index that was built, appended to and opened anew."""
    queries, index = _index(spark, folder)
    return _rounded(index.search(queries, key="vec_id"))


def similar_topk_probed(spark, folder):
    """The approximate mode against the exact one, over all vectors."""
    queries, index = _index(spark, folder)
    exact = top_k_similar(queries, queries.withColumnRenamed("Query_ID", "vec_id"), key="vec_id")
    found = index.search(queries, key="vec_id", probes=index.probes_for(queries))
    return recall(found, exact, key="vec_id").select("Queries", (F.col("Recall") >= 0.9).alias("Recall_Reached"))


def _past_tickets(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("Ticket_ID"), F.col("text").alias("Description_Text"),
        F.concat(F.lit("Report from "), F.col("source")).alias("Short_Description"),
        F.concat(F.lit("Handled in "), F.col("lang")).alias("Resolution_Notes"),
    )
    return materialize(embed(docs, letter_encoder, "Description_Text"), "past")


def _new_tickets(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("Query_ID"), F.col("text").alias("Ticket_Text"))


def resolution_prompt(spark, folder):
    queries = _new_tickets(spark, folder)
    hits = retrieve_tickets(embed(queries, letter_encoder, "Ticket_Text"), _past_tickets(spark, folder))
    prompts = resolution_prompts(queries, hits, task="Solve.")
    return prompts.select("Query_ID", F.md5("Prompt").alias("Prompt_Hash"))


def resolve_tickets_query(spark, folder):
    answers, _ = resolve_tickets(_new_tickets(spark, folder), _past_tickets(spark, folder), letter_encoder, echo_generator)
    return answers.select("Query_ID", "Reply", "Error")


QUERIES = {
    "similar_topk": similar_topk,
    "similar_topk_blocked": similar_topk_blocked,
    "similar_topk_nan": similar_topk_nan,
    "similar_topk_indexed": similar_topk_indexed,
    "similar_topk_probed": similar_topk_probed,
    "resolution_prompt": resolution_prompt,
    "resolve_tickets": resolve_tickets_query,
}

_TOPK = """SELECT q AS "Query_ID", v AS vec_id, round_even(s * 1e6, 0) / 1e6 AS "Similarity",
  CAST(row_number() OVER (PARTITION BY q ORDER BY s DESC, v) AS INTEGER) AS "Rank"
FROM (SELECT a.vec_id AS q, b.vec_id AS v, round_even(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) * 1e12, 0) / 1e12 AS s FROM embeddings a, embeddings b)
QUALIFY "Rank" <= 5"""


def _letters_sql(c: str) -> str:
    return "[" + ", ".join(f"(length({c}) - length(replace({c}, '{x}', '')))::DOUBLE" for x in _LETTERS) + "]"


_CONTEXT = f"""
WITH q AS (SELECT item_id, text, {_letters_sql("text")} AS e FROM benchmark),
d AS (SELECT doc_id, text, source, lang, {_letters_sql("text")} AS e FROM documents),
hits AS (
  SELECT item_id, doc_id, s, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS rank
  FROM (SELECT item_id, doc_id, coalesce(round_even(nullif(list_cosine_similarity(q.e, d.e), 'nan'::DOUBLE) * 1e12, 0) / 1e12, 0) AS s FROM q, d) QUALIFY rank <= 5
),
context AS (
  SELECT item_id, string_agg('#' || rank || ' cosine ' || printf('%.2f', round_even(s * 100, 0) / 100) || '
Reported: ' || regexp_replace('Report from ' || source || ' ' || text, '^[\\s\\x{{85}}\\p{{Z}}]+|[\\s\\x{{85}}\\p{{Z}}]+$', '', 'g') || '
Solved by: ' || 'Handled in ' || lang, '

' ORDER BY rank) AS context FROM hits JOIN d USING (doc_id) GROUP BY 1
)
"""


def _prompt_sql(task: str) -> str:
    quoted = task.replace("'", "''")
    return f"""'{quoted}
New ticket:
"' || text || '"

Past tickets:
' || context || '
'"""


SQL = {
    "similar_topk": _TOPK,
    "similar_topk_blocked": _TOPK,
    "similar_topk_indexed": _TOPK,
    "similar_topk_probed": """SELECT count(*) AS "Queries", true AS "Recall_Reached" FROM embeddings""",
    "similar_topk_nan": """SELECT q AS "Query_ID", v AS vec_id, CAST(row_number() OVER (PARTITION BY q ORDER BY s DESC, v) AS INTEGER) AS "Rank"
FROM (SELECT a.vec_id AS q, b.vec_id AS v, round_even(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) * 1e12, 0) / 1e12 AS s
  FROM embeddings a, embeddings b WHERE a.vec_id % 7 >= 3 AND b.vec_id % 7 >= 3)
QUALIFY "Rank" <= 5""",
    "resolution_prompt": f"""{_CONTEXT} SELECT item_id AS "Query_ID", md5({_prompt_sql("Solve.")}) AS "Prompt_Hash"
FROM q JOIN context USING (item_id)""",
    "resolve_tickets": f"""{_CONTEXT} SELECT item_id AS "Query_ID",
length({_prompt_sql(ANSWER_TASK)}) || ' characters, at most 500 tokens' AS "Reply", CAST(NULL AS VARCHAR) AS "Error"
FROM q JOIN context USING (item_id)""",
}
