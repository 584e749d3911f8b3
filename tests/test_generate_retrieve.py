import numpy as np
import pytest
from pyspark.sql import functions as F

from migratrace.operators import generate as G
from migratrace.operators.retrieve import resolution_prompts, resolve_tickets, retrieve_tickets, top_k_similar


def test_reply_kinds(spark):
    good = '{"Cluster_Name": "n", "Analysis": 5}'
    replies = {
        "plain": f"  {good}\n", "fenced": f"```json\n{good}\n```", "bare fence": f"```\n{good}```", "prose": f"Sure: {good} ok?",
        "list": f"[{good}]", "broken": '{"Cluster_Name": ', "none": None, "empty": "", "two": f"{good} and {good}", "multi line": 'x {"Cluster_Name":\n "n",\n "Analysis": "5"} y',
    }
    df = spark.createDataFrame(list(replies.items()), "kind string, Reply string")
    got = {r["kind"]: r["parsed"] for r in G.parse_reply(df, G.NAMING_SCHEMA).collect()}
    for kind in ("plain", "fenced", "bare fence", "prose", "multi line"):
        assert (got[kind]["Cluster_Name"], got[kind]["Analysis"], got[kind]["Recommendation"]) == ("n", "5", None), kind
    assert all(got[k] is None for k in ("list", "broken", "none", "empty", "two"))


def test_failures_keep_earlier_values(spark):
    catalog = spark.createDataFrame(
        [(0, "k0", "old", "a0", "r0"), (1, "k1", "old", "a1", None), (2, "k2", "old", "a2", "r2"), (3, "k3", None, None, None)],
        "Cluster_ID int, Top_Keywords string, Cluster_Name string, Analysis string, Recommendation string",
    )
    prompts = spark.createDataFrame([(0, "ok"), (1, "bad"), (2, "raise")], "Cluster_ID int, Prompt string")

    def load():
        def reply(prompt, limit):
            if prompt == "raise":
                raise RuntimeError("down")
            return '{"Analysis": "new"}' if prompt == "ok" else "?"

        return reply

    replies = G.generate(prompts, load, "Cluster_ID")
    assert {r["Cluster_ID"]: r["Error"] for r in replies.collect()} == {0: None, 1: None, 2: "RuntimeError: down"}
    got = {r["Cluster_ID"]: (r["Cluster_Name"], r["Analysis"], r["Recommendation"]) for r in G.enrich_catalog(catalog, replies).collect()}
    assert got == {0: ("k0", "new", ""), 1: ("k1", "a1", ""), 2: ("k2", "a2", "r2"), 3: ("k3", "", "")}


def test_prompt_samples(spark):
    catalog = spark.createDataFrame([(0, 5, 1.0, "k", "d"), (1, 9, 1.0, "k1", None), (-1, 99, 9.0, "n", "n")], "Cluster_ID int, Size long, Business_Priority double, Top_Keywords string, Primary_Domains string")
    tickets = spark.createDataFrame([(f"T{i:02d}", 0, None if i == 0 else f"s{i}") for i in range(14)], "Ticket_ID string, Cluster_ID int, Short_Description string")
    prompts = {r["Cluster_ID"]: r["Prompt"] for r in G.naming_prompts(catalog, tickets).collect()}
    assert set(prompts) == {0, 1}
    assert prompts[0].endswith("Samples:\n" + "\n".join(f"s{i}" for i in range(1, 11)) + "\n")
    assert [r["Cluster_ID"] for r in G.top_clusters(catalog, 1).collect()] == [1]


def corpus(spark, n=200, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8))
    x[3] = 0.0
    x[10:60] = x[10]  # a quarter are copies
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return x, spark.createDataFrame(rows + [(n, None)], "Ticket_ID int, Embedding array<double>")


def brute(q, x, k):
    def unit(m):
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)

    s = np.round(unit(q) @ unit(x).T, 10)
    return [[(int(j), s[i, j]) for j in sorted(range(len(x)), key=lambda j: (-s[i, j], j))[:k]] for i in range(len(q))]


@pytest.mark.parametrize("options", [{}, {"shipped_values": 0, "per_block": 16, "max_cells": 5}], ids=["shipped", "blocks"])
def test_top_k_against_brute_force(spark, options):
    x, tickets = corpus(spark)
    q = np.vstack([x[:20], np.zeros((1, 8)), x[10:12] * 3])
    queries = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(q)], "Query_ID int, Embedding array<double>")
    got = {}
    for r in top_k_similar(queries, tickets, 5, **options).orderBy("Query_ID", "Rank").collect():
        got.setdefault(r["Query_ID"], []).append((r["Ticket_ID"], round(r["Similarity"], 10)))
    assert [got[i] for i in range(len(q))] == [[(j, pytest.approx(s, abs=1e-9)) for j, s in want] for want in brute(q, x, 5)]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="vectorized"):
        top_k_similar(spark.range(1), spark.range(1), query_key="id", key="id")
    none = spark.createDataFrame([(1, None)], "id int, Embedding array<double>")
    with pytest.raises(ValueError, match="no ticket"):
        top_k_similar(none, none, query_key="id", key="id")


def test_prompts_and_answers(spark):
    past = spark.createDataFrame([("a", "Sync fails ", None, "restart"), ("b", "Login", "page", None)], "Ticket_ID string, Short_Description string, Description_Text string, Resolution_Notes string")
    past = past.withColumn("Embedding", F.when(F.col("Ticket_ID") == "a", F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.6), F.lit(0.8))))
    new = spark.createDataFrame([(1, "xx"), (2, "xxyy")], "Query_ID int, Ticket_Text string")
    load_encoder = lambda: (lambda texts: np.array([[t.count("x"), t.count("y")] for t in texts], dtype=float))
    answers, hits = resolve_tickets(new, past, load_encoder, lambda: (lambda p, n: f"{n}:{p.count(' cosine ')}"))
    assert {r["Query_ID"]: r["Reply"] for r in answers.collect()} == {1: "500:2", 2: "500:2"}
    prompt = resolution_prompts(new, hits, task="T").where("Query_ID = 1").first()["Prompt"]
    assert "#1 cosine 1.00\nReported: Sync fails\nSolved by: restart\n\n#2 cosine 0.60\nReported: Login page\nSolved by: \n" in prompt
    assert retrieve_tickets(new.withColumn("Embedding", F.array(F.lit(0.0), F.lit(1.0))), past, 1).select("Ticket_ID").distinct().collect()[0][0] == "b"


def test_summary_defaults_and_rows(spark):
    df = spark.createDataFrame([(1, "nothing", None), (2, None, "E: x"), (3, '{"key_findings": [{"title": "t"}]}', None)], "k int, Reply string, Error string")
    parsed = G.parse_summary(df)
    got = {r["k"]: (r["executive_narrative"], r["legacy_to_dbb_verdict"], r["key_findings"]) for r in parsed.collect()}
    assert got[1] == (G.INVALID_REPLY, "INSUFFICIENT_DATA", []) and got[2][0] == G.FAILED_CALL
    assert got[3][0] is None and got[3][1] is None
    assert [(r["k"], r["title"], r["detail"]) for r in G.summary_rows(parsed, "key_findings").collect()] == [(3, "t", "")]
