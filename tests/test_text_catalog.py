import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from migratrace.functions.columns import hours_text, signed_percent, year_month
from migratrace.functions.text import STOP_WORDS, clean_text, error_codes
from migratrace.operators.catalog import build_catalog, cluster_cohesion, cluster_keywords, primary_domains
from migratrace.operators.embed import embed, hashed_embedding
from migratrace.operators.quantiles import exact_median
from migratrace.operators.terms import Summary, count_terms, counters_that_matter, frequent_candidates, vocabulary_counts
from migratrace.operators.textprep import lemmatize, prepare_text


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c"))).first()[0]


def test_clean_text(spark):
    assert one(spark, clean_text, "<b>Hi</b>  http://x.y/z?q=1 [URL][IP] 10.0.0.1 ÜBER ALL\n[TICKET] [phone]") == "hi über all [phone]"
    assert one(spark, clean_text, None) == ""
    assert one(spark, clean_text, "a < b > c") == "a c"


def test_error_codes(spark):
    assert one(spark, error_codes, "ERR-1234 err_99 Exception error code 5 exception ERR9") == "err-1234 err_99 error code 5 exception"
    assert one(spark, error_codes, None) == ""


def test_prepare_and_lemmas(spark):
    df = spark.createDataFrame([("1", "Users can't", None, "logged in v2 twice")], "Ticket_ID string, Short_Description string, Description_Text string, Resolution_Notes string")
    ready = prepare_text(df)
    assert ready.first()["Full_Text"] == "Users can't  logged in v2 twice"
    assert lemmatize(ready).first()["Lemma_Text"] == "users logged twice"
    words = spark.createDataFrame([("users", "user"), ("logged", "log")], "word string, lemma string")
    assert lemmatize(ready, lemmas=words).first()["Lemma_Text"] == "user log twice"
    empty = spark.createDataFrame([("1", "the of")], "Ticket_ID string, Clean_Text string")
    assert lemmatize(empty, lemmas=words).first()["Lemma_Text"] == ""


def test_formats(spark):
    assert [one(spark, hours_text, v, "double") for v in (None, 5.04, 23.99, 24.0, 60.0)] == ["N/A", "5.0h", "24.0h", "1.0d", "2.5d"]
    assert [one(spark, signed_percent, v, "double") for v in (12.5, -3.2, 0.0)] == ["+12%", "-3%", "+0%"]
    assert one(spark, lambda c: year_month(c.cast("timestamp_ntz")), None) == "NaT"


def brute_keywords(docs, max_terms=1000, top=5):
    import re

    grams = []
    for text in docs:
        words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in STOP_WORDS]
        grams.append(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    uses, df = {}, {}
    for g in grams:
        for t in g:
            uses[t] = uses.get(t, 0) + 1
        for t in set(g):
            df[t] = df.get(t, 0) + 1
    vocabulary = sorted(uses, key=lambda t: (-uses[t], t))[:max_terms]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocabulary}
    score = {}
    for g in grams:
        w = {t: g.count(t) * idf[t] for t in set(g) if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            score[t] = score.get(t, 0) + v / norm
    best = sorted(score, key=lambda t: (-round(score[t], 9), t))[:top]
    return ", ".join(best) or "N/A"


def test_keywords_against_brute_force(spark):
    rng = random.Random(1)
    words = ["sync", "route", "invoice", "the", "printer", "login", "fails", "of", "été", "naïve"]
    docs = {c: [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(20)] for c in (0, 1)}
    docs[2] = ["the of a", ""]
    rows = [(f"{c}-{i}", c, t) for c, texts in docs.items() for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "Ticket_ID string, Cluster_ID int, Lemma_Text string")
    for limit, counters in ((1000, 16_000), (6, 16_000), (6, 12), (6, 2), (1000, 1)):
        found = cluster_keywords(df, max_terms=limit, counters=counters)
        got = {r["Cluster_ID"]: r["Top_Keywords"] for r in found.collect()}
        assert got == {c: brute_keywords(texts, limit) for c, texts in docs.items()}


def test_summaries_bound_the_counts():
    rng = random.Random(3)
    true, summary = Counter(), Summary(10)
    for _ in range(400):
        text = [f"w{int(rng.expovariate(0.08))}" for _ in range(12)]
        true.update(text)
        summary.add(text)
    assert summary.error > 0 and len(summary.counts) <= 20
    for term, n in true.items():
        low = summary.counts.get(term, 0)
        assert low <= n <= low + summary.error


def test_vocabulary_from_summaries_is_exact(spark):
    """Whatever the summaries hold and however often a task flushes them, the counts are those of all texts."""
    rng = random.Random(8)
    rows = [(c, " ".join(f"w{min(int(rng.expovariate(0.1)), 40)}" for _ in range(rng.randint(0, 30)))) for c in ["a", "b", None] for _ in range(60)]
    want = {}
    for c in ("a", "b"):
        uses, docs = Counter(), Counter()
        for d, text in rows:
            if d == c:
                words = text.split()
                grams = words + [f"{x} {y}" for x, y in zip(words, words[1:])]
                uses.update(grams)
                docs.update(set(grams))
        for term in sorted(uses, key=lambda t: (-uses[t], t))[:8]:
            want[c, term] = (uses[term], docs[term])
    texts = spark.createDataFrame(rows, "cluster string, words string").repartition(3)
    for counters, task_counters in ((16_000, 1 << 20), (150, 1 << 20), (40, 90), (3, 5)):
        counts, lows, sizes = count_terms(texts, counters, task_counters)
        assert {(r["cluster"], r["n"]) for r in sizes.collect()} == {("a", 60), ("b", 60)}
        kept, hits = vocabulary_counts(counts, frequent_candidates(counts, lows, sizes, 8), 8)
        assert {(r["cluster"], r["term"]): (r["uses"], r["docs"]) for r in kept.collect()} == want
    empty = count_terms(texts.limit(0))
    assert vocabulary_counts(empty[0], frequent_candidates(*empty, 8), 8)[0].count() == 0


def test_few_counters_are_sent_and_texts_are_kept_as_texts(spark):
    """Rare terms of a task never leave it; candidates that go to every task and those that are joined count alike."""
    rng = random.Random(9)
    rows = [(c, " ".join(rng.choices([f"w{min(int(rng.expovariate(0.3)), 20)}", f"rare{i}x{c}"], (9, 1))[0] for _ in range(20))) for i in range(300) for c in (1, 2)]
    rows += [(1, ""), (2, None), (3, ""), (4, "alone")]
    uses = Counter((c, t) for c, text in rows for w in [text.split() if text else []] for t in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    want = {(c, t): uses[c, t] for k in (1, 2, 4) for c, t in sorted((x for x in uses if x[0] == k), key=lambda x: (-uses[x], x[1]))[:6]}
    texts, lows, sizes = count_terms(spark.createDataFrame(rows, "cluster int, words string").repartition(4))
    assert texts.columns == ["cluster", "row", "words"]
    assert {(r["cluster"], r["n"]) for r in sizes.collect()} == {(1, 301), (2, 301), (3, 1), (4, 1)}
    sent, bounds = counters_that_matter(lows, sizes, 6)
    assert sent.count() < lows.count() / 10 and bounds.where("least > 1").count() == 2
    candidates = frequent_candidates(texts, lows, sizes, 6)
    assert candidates.count() < 60
    for shipped in (100, 0):
        kept, hits = vocabulary_counts(texts, candidates, 6, shipped)
        assert {(r["cluster"], r["term"]): r["uses"] for r in kept.collect()} == want
        assert hits.groupBy("row", "t").count().where("count > 1").count() == 0


def test_cohesion_equals_pairwise_mean(spark):
    rng = np.random.default_rng(0)
    groups = {0: rng.normal(size=(12, 6)), 1: rng.normal(size=(1, 6)), 2: np.vstack([np.zeros((1, 6)), rng.normal(size=(4, 6))])}
    rows = [(c, [float(v) for v in x]) for c, m in groups.items() for x in m]
    got = {r["Cluster_ID"]: r["Cohesion"] for r in cluster_cohesion(spark.createDataFrame(rows, "Cluster_ID int, Embedding array<double>")).collect()}
    for c, m in groups.items():
        n = len(m)
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        u = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
        want = 1.0 if n == 1 else (u @ u.T)[~np.eye(n, dtype=bool)].mean()
        assert abs(got[c] - want) < 1e-12


def test_domains_and_catalog_order(spark):
    rows = [(f"t{i}", c, d, "printer login", [1.0, float(i % 2)]) for i, (c, d) in enumerate([(0, "B"), (0, "A"), (0, "B"), (0, "C"), (1, None), (-1, "A")])]
    df = spark.createDataFrame(rows, "Ticket_ID string, Cluster_ID int, Domain string, Lemma_Text string, Embedding array<double>")
    assert {r["Cluster_ID"]: r["Primary_Domains"] for r in primary_domains(df.where("Cluster_ID >= 0")).collect()} == {0: "B | A"}
    catalog = build_catalog(df).collect()
    assert [r["Cluster_ID"] for r in catalog] == [0, 1]
    assert catalog[1]["Cohesion_Score"] == 1.0 and catalog[1]["Primary_Domains"] == ""
    assert catalog[0]["Top_Keywords"] == "login, printer, printer login"


def test_exact_median(spark):
    rng = random.Random(4)
    groups = {"a": [rng.choice([0.1, 0.1, 5.5, 100.25]) for _ in range(101)], "b": [1.0, 2.0, 4.0, 100.0], "c": [7.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("d", None)]
    got = {r["g"]: (r["median"], r["n"], r["mean"]) for r in exact_median(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert got == {"d": (None, 0, None)} | {g: (float(np.median(vs)), len(vs), pytest.approx(np.mean(vs))) for g, vs in groups.items()}


def test_embedding_hooks(spark):
    df = spark.createDataFrame([("ab",), (None,), ("bbb",)], "Clean_Text string")
    got = embed(df, lambda: (lambda texts: np.array([[len(t), t.count("b")] for t in texts]))).collect()
    assert {r["Clean_Text"]: list(r["Embedding"]) for r in got} == {"ab": [2.0, 1.0], None: [0.0, 0.0], "bbb": [3.0, 3.0]}
    hashed = hashed_embedding(spark.createDataFrame([("printer login",), ("printer route",), ("",)], "Clean_Text string"), size=64)
    norms = sorted(round(sum(v * v for v in r["Embedding"]), 6) for r in hashed.collect())
    assert norms[0] == 0.0 and norms[1:] == [1.0, 1.0]
