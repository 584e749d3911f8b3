"""Similar past tickets for new ones, and answers built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migratrace.functions.columns import col, fixed
from migratrace.operators.blocks import (
    MAX_CELLS,
    ROWS_PER_BLOCK,
    choose_pivots,
    describe_cells,
    finite,
    matrix,
    to_cells,
)
from migratrace.operators.embed import Encoder, embed
from migratrace.operators.generate import ANSWER_TOKENS, Generator, generate
from migratrace.operators.neighbours import best_cosines, nearest_in_blocks
from migratrace.session import materialize

TOP_K = 5
# Up to this many vector values in all, the new tickets go to every task at once.
SHIPPED_VALUES = 4_000_000

ANSWER_TASK = (
    "Suggest a short step-by-step solution for the new support ticket, based only on the resolution notes of the "
    "past tickets below. If they hold no clear solution, say that a person has to look at it.\n"
)


def usable_vectors(tickets: DataFrame, vector: str = "Embedding") -> DataFrame:
    """Tickets with a vector of finite numbers; an error when the column is missing."""
    if vector not in tickets.columns:
        raise ValueError(f"no column {vector!r}: the tickets have to be vectorized first")
    return tickets.where(finite(col(vector)))


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    return usable_vectors(df, vector).select(col(key).alias("id"), col(vector).cast("array<double>").alias("vec"))


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("Similarity"), "other")
    return scores.withColumn("Rank", F.row_number().over(best)).where(F.col("Rank") <= k)


def _shipped(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """All queries in every task: one scan of the corpus, k rows per query and batch."""
    rows = queries.collect()  # within SHIPPED_VALUES, checked by the caller
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(
        (np.array([r["id"] for r in rows], dtype=object), np.array([r["vec"] for r in rows], dtype=np.float64))
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        for batch in batches:
            if not len(batch):
                continue
            # ids ascend, so equal cosines are settled by id
            batch = batch.sort_values("id", ignore_index=True)
            row, at, similarity = best_cosines(q, matrix(batch["vec"]), k)
            yield pd.DataFrame({"query": ids[row], "other": batch["id"].to_numpy()[at], "Similarity": similarity})

    q_type, c_type = queries.schema["id"].dataType.simpleString(), corpus.schema["id"].dataType.simpleString()
    return _ranked(corpus.mapInPandas(score, f"query {q_type}, other {c_type}, Similarity double"), k)


def _lifted(df: DataFrame, is_query: bool) -> DataFrame:
    """Unit vectors with two extra places, where a zero vector gets a direction of its own.

    Cosine order is then distance order, and a zero vector has cosine 0 with all.
    """
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x))
    extra = F.array(F.lit(0.0), F.lit(1.0)) if is_query else F.array(F.lit(1.0), F.lit(0.0))
    zeros = F.array(F.lit(0.0), F.lit(0.0))
    return df.withColumn("__n", norm).select(
        "id",
        F.when(F.col("__n") > 0, F.concat(F.transform("vec", lambda x: x / F.col("__n")), zeros))
        .otherwise(F.concat(F.transform("vec", lambda x: F.lit(0.0)), extra)).alias("vec"),
    )


def lifted_vectors(df: DataFrame, key: str, vector: str, is_query: bool) -> DataFrame:
    """Usable vectors (id, vec) such that distance order is cosine order."""
    return _lifted(_vectors(df, key, vector), is_query)


def _blocked(queries: DataFrame, corpus: DataFrame, k: int, per_block: int, max_cells: int) -> DataFrame:
    """Both sides in bounded blocks; only blocks that can hold a neighbour meet.

    Of equal vectors only the k smallest ids can be among the k nearest, so no
    query meets more copies than that.
    """
    among_copies = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    first_copies = corpus.withColumn("__copy", among_copies).where(F.col("__copy") <= k).drop("__copy")
    points, asked = materialize(first_copies, "corpus"), queries
    pivot_ids, pivots = choose_pivots(points, points.count(), max_cells, per_block)
    points, cells = describe_cells(to_cells(points, pivots), pivots, pivot_ids, per_block)
    asked, asked_cells = describe_cells(to_cells(asked, pivots), pivots, pivot_ids, per_block)
    found = nearest_in_blocks(asked, asked_cells, points, cells, k, cosine=True, per_block=per_block)
    return found.select(F.col("id").alias("query"), "other", (-F.col("distance")).alias("Similarity"), F.col("rank").alias("Rank"))


def top_k_similar(
    queries: DataFrame,
    tickets: DataFrame,
    k: int = TOP_K,
    query_key: str = "Query_ID",
    key: str = "Ticket_ID",
    vector: str = "Embedding",
    query_vector: str | None = None,
    shipped_values: int = SHIPPED_VALUES,
    per_block: int = ROWS_PER_BLOCK,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """The k tickets of highest cosine per query: query key, ticket key, Similarity, Rank.

    Few queries are sent to all tasks (their size is counted first) and the
    tickets are scanned once; many queries meet the tickets in bounded block
    pairs.  Both ways score a pair by the same sum, to 12 decimals, so this is a
    choice of plan only.  Ties rank by ticket key; a zero vector scores 0, and
    vectors with a component that is null, NaN or infinite take no part.
    """
    asked = materialize(_lifted(_vectors(queries, query_key, query_vector or vector), True), "queries")
    corpus = _lifted(_vectors(tickets, key, vector), False)
    if corpus.limit(1).count() == 0:
        raise ValueError("no ticket has a vector")
    values = asked.agg(F.coalesce(F.sum(F.size("vec")), F.lit(0)).alias("n")).first()["n"]
    found = _shipped(asked, corpus, k) if 0 < values <= shipped_values else _blocked(asked, corpus, k, per_block, max_cells)
    return found.select(F.col("query").alias(query_key), F.col("other").alias(key), "Similarity", F.col("Rank").cast("int").alias("Rank"))


def retrieve_tickets(queries: DataFrame, tickets: DataFrame, k: int = TOP_K, query_key: str = "Query_ID", key: str = "Ticket_ID", **options) -> DataFrame:
    """The similar tickets with all their columns.

    The found keys are a written table of k rows per query, so the join back is
    planned from its real size.
    """
    found = materialize(top_k_similar(queries, tickets, k, query_key, key, **options), "found")
    return found.join(tickets, key)


def resolution_prompts(
    queries: DataFrame, hits: DataFrame, query_key: str = "Query_ID", text: str = "Ticket_Text", task: str = ANSWER_TASK
) -> DataFrame:
    """One prompt per new ticket with its hits in rank order."""
    def part(name: str) -> Column:
        return F.coalesce(col(name), F.lit("")) if name in hits.columns else F.lit("")

    described = F.regexp_replace(F.concat(part("Short_Description"), F.lit(" "), part("Description_Text")), r"(?U)^\s+|\s+$", "")
    block = F.concat(
        F.lit("#"), F.col("Rank").cast("string"), F.lit(" cosine "), fixed(F.col("Similarity"), 2),
        F.lit("\nReported: "), described, F.lit("\nSolved by: "), part("Resolution_Notes"),
    )
    context = (
        hits.groupBy(col(query_key).alias("__q"))
        .agg(F.array_sort(F.collect_list(F.struct("Rank", block.alias("text")))).alias("h"))
        .select("__q", F.array_join(F.transform("h", lambda h: h["text"]), "\n\n").alias("context"))
    )
    prompt = F.concat(
        F.lit(f"{task}\nNew ticket:\n\""), F.coalesce(col(text), F.lit("")), F.lit("\"\n\nPast tickets:\n"),
        F.coalesce("context", F.lit("")), F.lit("\n"),
    )
    return queries.join(context, col(query_key) == F.col("__q"), "left").select(col(query_key), prompt.alias("Prompt"))


def resolve_tickets(
    queries: DataFrame,
    tickets: DataFrame,
    load_encoder: Callable[[], Encoder],
    load_generator: Callable[[], Generator],
    k: int = TOP_K,
    query_key: str = "Query_ID",
    text: str = "Ticket_Text",
    key: str = "Ticket_ID",
    vector: str = "Embedding",
    max_tokens: int = ANSWER_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """Answers for a table of new tickets, and the past tickets they rest on."""
    asked = materialize(embed(queries, load_encoder, text, vector), "asked")
    hits = retrieve_tickets(asked, tickets, k, query_key, key, vector=vector, query_vector=vector)
    answers = generate(resolution_prompts(queries, hits, query_key, text), load_generator, query_key, max_tokens=max_tokens)
    return answers, hits
