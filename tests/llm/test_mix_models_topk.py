"""Mixing, language identification, quality classifier, top-k search and the pipeline."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from migratrace.llm import topk
from migratrace.llm.cotrain import fit_quality_model, score_documents
from migratrace.llm.lang_id import BUCKETS, _packed, _unpacked, fit_language_model, identify
from migratrace.llm.mixing import Mix, mix_documents, mix_report
from migratrace.llm.topk import BallTree, top_inner_products
from tests.llm.helpers import ODD, odd_table, words

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def shared_out(sizes, weights, total, repeats):
    capped = set()
    while True:
        rest = total - sum(repeats * sizes[s] for s in capped)
        weight = sum(weights[s] for s in sizes if s not in capped)
        target = {s: repeats * sizes[s] if s in capped else rest * weights[s] / weight for s in sizes}
        over = {s for s in sizes if s not in capped and target[s] > repeats * sizes[s]}
        if not over:
            return target
        capped |= over


def test_sources_give_their_targets_and_reruns_agree(spark):
    df = documents(spark)
    rows = df.select("doc_id", "source", "text").collect()
    got = {r["doc_id"]: r for r in mix_report(df).collect()}
    size, taken = {}, {}
    for r in rows:
        n = len(words(r["text"]))
        assert got[r["doc_id"]]["size"] == n and got[r["doc_id"]]["taken"] <= 2 * n
        size[r["source"]] = size.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + got[r["doc_id"]]["taken"]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    target = shared_out(size, weights, 1.5 * sum(size.values()), 2)
    for r in rows:
        assert got[r["doc_id"]]["target"] == pytest.approx(target[r["source"]], abs=1e-6)
        assert got[r["doc_id"]]["source_size"] == size[r["source"]]
    assert all(abs(taken[s] - target[s]) <= 2 for s in size)
    assert {r["doc_id"]: r for r in mix_report(df.repartition(3)).collect()} == got
    texts = {}
    for r in mix_documents(df).collect():
        texts[r["doc_id"]] = texts.get(r["doc_id"], 0) + len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert texts == {d: r["taken"] for d, r in got.items() if r["taken"]}


def test_blocks_come_once_per_pass(spark):
    mix = Mix(documents(spark), block=16, shard=64)
    slots = mix.slots.groupBy("sid", "pass").agg(F.count("*").alias("n"), F.countDistinct("block").alias("d")).collect()
    assert all(r["n"] == r["d"] for r in slots)
    assert mix.slots.groupBy("sid", "slot").count().where("count > 1").count() == 0
    assert mix.slots.select("shard").distinct().count() > 10


def test_mix_of_odd_rows(spark):
    df = odd_table(spark)
    got = sorted((str(r["doc_id"]), r["size"]) for r in mix_report(df).collect())
    assert got == sorted((str(d), len(words(t))) for d, t, *_ in ODD)
    mixed = mix_documents(df)
    assert mixed.columns == df.columns
    originals = {t for _, t, *_ in ODD}
    assert {r["text"] for r in mixed.collect() if r["doc_id"] == 6} <= originals | {""}
    assert mix_report(df.limit(0)).collect() == [] and mix_documents(df.limit(0)).collect() == []
    empty = df.where("doc_id IN (1, 2, 3)")
    assert {r["taken"] for r in mix_report(empty).collect()} == {0} and mix_documents(empty).collect() == []


def test_languages_are_learned_and_the_unreadable_is_rejected(spark):
    df = documents(spark)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit_language_model(df.where(~held))
    again = fit_language_model(df.repartition(3).where(~held))
    assert model.languages == again.languages and np.allclose(model.weights, again.weights)
    found = identify(df, model).where(held).select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95 and all(0 <= r["score"] <= 1 for r in found)
    odd = identify(odd_table(spark), model).select("doc_id", "text", "lang_pred", "score", "rejected").collect()
    assert len(odd) == len(ODD)
    for r in odd:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or (r["score"] == 0 and r["rejected"]))
    assert fit_language_model(df.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in identify(df.limit(3), None).collect()} == {"und"}
    assert identify(df.limit(0), model).collect() == []


def test_the_language_sample_stays_out_of_the_driver(spark, monkeypatch):
    rows = [(i, f"{'der Hund und die Katze' if i % 2 else 'the dog and the cat'} {i}", "de" if i % 2 else "en") for i in range(300)]
    docs = spark.createDataFrame([*rows, (300, "12 34", "en"), (301, None, "de"), (302, "no language", None)], "doc_id long, text string, lang string")
    got = []

    def counted(call):
        def run(self, *args, **options):
            out = call(self, *args, **options)
            got.append(len(out))
            return out

        return run

    for name in ("collect", "toPandas", "toArrow"):
        monkeypatch.setattr(type(docs), name, counted(getattr(type(docs), name)))
    model = fit_language_model(docs)
    assert got and max(got) <= 2 and model.languages == ["de", "en"] and model.weights.shape == (BUCKETS, 2)
    monkeypatch.undo()
    found = identify(docs.where("doc_id < 300"), model).select("lang", "lang_pred").collect()
    assert len(found) == 300 and all(r["lang"] == r["lang_pred"] for r in found)
    assert fit_language_model(docs.where("doc_id IN (300, 301)")) is None


def test_packed_features_are_the_features():
    for buckets, counts in (([], []), ([0], [1]), ([BUCKETS - 1], [1 << 30]), ([0, 1, 40_000, BUCKETS - 1], [3, 70_000, 1, 2])):
        got = _unpacked(_packed(np.array(buckets, np.uint32), np.array(counts, np.int64)))
        assert [x.tolist() for x in got] == [buckets, counts] and all(x.dtype == np.int32 for x in got)


def test_quality_model_separates_the_classes(spark):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_quality_model(base, labels.where("doc_id % 3 <> 0"))
    rows = score_documents(base, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.9 and np.mean(junk) < 0.2
    odd = score_documents(odd_table(spark), model).collect()
    assert len(odd) == len(ODD) and all(not r["kept"] and r["score"] == 0 for r in odd if r["doc_id"] in (1, 2, 3))
    assert fit_quality_model(base, labels.where("quality = 1 AND toxic = 0")) is None
    assert fit_quality_model(base.limit(0), labels) is None and fit_quality_model(base, labels.limit(0)) is None
    assert {r["kept"] for r in score_documents(odd_table(spark), None).where("doc_id IN (1, 4)").collect()} == {False, True}


def brute_top(rows, asked, k=5):
    v = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v[i] = [math.floor(256 * c) for c in x]
    out = []
    for q in (q for q in v if asked(q)):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q and len(v[c]) == len(v[q]))
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best[:k])]
    return sorted(out)


def test_top_k_is_exact_with_ties_copies_and_broken_vectors(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_ROWS", 7), ("LEAF_ROWS", 4)):
        monkeypatch.setattr(topk, name, value)
    draw, rows = np.random.default_rng(1), []
    for i in range(300):
        v = [float(x) for x in draw.normal(0, 0.1, 8).astype("float32")]
        if i % 3 == 0:
            v = [0.5] * 8
        if i % 41 == 0:
            v[2] = float("nan")
        if i % 43 == 0:
            v[1] = None
        if i % 47 == 0:
            v = None
        if i % 37 == 0:
            v = [0.25] * 3
        rows.append((i, v))
    rows += [(6, rows[6][1]), (None, [0.1] * 8), (400, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("ids", F.lit(0)).withColumn("score", F.lit(0))
    got = sorted(tuple(r) for r in top_inner_products(df.where("vec_id % 5 = 0"), df).collect())
    assert got == brute_top(rows, lambda q: q % 5 == 0)
    assert top_inner_products(df.limit(0), df.limit(0)).collect() == []


def test_top_k_broadcasts_no_vectors(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_ROWS", 7)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(2)
    df = spark.createDataFrame([(i, draw.normal(0, 0.1, 8).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    found = top_inner_products(df.where("vec_id % 5 = 0"), df)
    assert found.count() == 300
    found.collect()
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = [part for part in plan.split("\n\n") if "BroadcastExchange" in part.split("\n")[0]]
    assert not [part for part in sent if "asked" in part or "items" in part]


def test_a_task_builds_each_tree_once_and_raises_the_floor(monkeypatch):
    built, floors, tree = [], [], topk.BallTree
    monkeypatch.setattr(topk, "BallTree", lambda v: built.append(len(v)) or tree(v))
    search = tree.search
    monkeypatch.setattr(tree, "search", lambda self, q, ids, k, floor: floors.append(floor) or search(self, q, ids, k, floor))
    draw = np.random.default_rng(7)
    v = draw.integers(-50, 50, (120, 4)).tolist()
    item = pa.list_(pa.struct([("ids", pa.list_(pa.int64())), ("v", pa.list_(pa.int64()))]))
    question = pa.list_(pa.struct([("id", pa.int64()), ("v", pa.list_(pa.int64())), ("floor", pa.int64()), ("cell", pa.int64()), ("part", pa.int64())]))
    schema = pa.schema([("dims", pa.int32()), ("cell", pa.int32()), ("part", pa.int64()), ("items", item), ("asked", question)])
    rows = [{"dims": 4, "cell": c, "part": 0, "items": [{"ids": [i], "v": v[i]} for i in range(40 * c, 40 * c + 40)]} for c in range(3)]
    rows += [{"dims": 4, "asked": [{"id": i, "v": v[i], "cell": 9, "part": 0} for i in range(b, 120, 4)]} for b in range(4)]
    got = [tuple(r.values()) for b in topk._answers(3, at_home=False)(pa.RecordBatch.from_pylist([r], schema) for r in rows) for r in b.to_pylist()]
    want = {(q, c, sum(a * b for a, b in zip(v[q], v[c], strict=True))) for q in range(120) for c in range(120) if c != q}
    best = [r for q in range(120) for r in sorted((w for w in want if w[0] == q), key=lambda w: (-w[2], w[1]))[:3]]
    assert sorted(got) == sorted(best)
    assert built == [40, 40, 40] and sum(f is None for f in floors) == 120 and len(floors) == 360


def test_ball_tree_search_with_large_components():
    draw = np.random.default_rng(6)
    v = draw.integers(-(1 << 27), 1 << 27, (500, 4))
    tree = BallTree(v)
    ids = tree.order
    for q in v[:20]:
        scores = v.astype(object) @ q.astype(object)
        want = sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:6]
        assert tree.search(q, ids, 6, None) == [(s, -i) for s, i in want]


def test_pipeline_stages_take_effect(spark):
    docs = documents(spark)
    copies = docs.limit(5).withColumn("doc_id", F.col("doc_id") + 10_000)
    lines = "A line of a licence that every one of these pages carries."
    marked = docs.where("doc_id BETWEEN 20 AND 25").withColumn("doc_id", F.col("doc_id") + 20_000).withColumn("text", F.concat(F.lit(f"{lines}\n"), F.col("text")))
    odd = spark.createDataFrame([(30_000, "12 34", "en", "s", 5), (None, "the cat and the dog of the house", "en", None, 5)], docs.schema)
    df = docs.unionByName(copies).unionByName(marked).unionByName(odd)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language_id"](spark, df, SF)
    assert one.columns == df.columns and one.where("doc_id = 30000").count() == 0 and one.count() >= df.count() - 2
    two = stages["line_dedup"](spark, one, SF)
    with_line = [r["doc_id"] for r in two.where(F.col("text").contains(lines)).collect()]
    assert with_line == [20_025] and two.count() == one.count()
    assert two.where("n_chars <> length(text)").where("doc_id IS NOT NULL").count() == 0
    three = stages["near_duplicates"](spark, df.where("doc_id IS NULL OR doc_id < 20000"), SF)
    kept = {r["doc_id"] for r in three.select("doc_id").collect()}
    assert None in kept and not {10_000 + r["doc_id"] for r in docs.limit(5).collect()} & kept and three.columns == df.columns
    four = stages["mixing"](spark, three, SF)
    assert four.columns == df.columns and {r["doc_id"] for r in four.select("doc_id").collect()} <= kept
    five = stages["sentencepiece"](spark, four, SF)
    assert five.count() == four.count()


def test_stages_with_odd_and_empty_tables(spark):
    df = odd_table(spark)
    for frame in (df, df.limit(0)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != "sentencepiece":
                assert docs.columns == df.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    random.seed(0)
