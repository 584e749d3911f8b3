"""Quality rules, line dedup and the set join against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from migratrace.llm import line_dedup, set_join, textscan
from migratrace.llm.common import components
from migratrace.llm.line_dedup import apply_bitmaps, keep_bitmaps, line_report
from migratrace.llm.quality_rules import RULES, _base, quality_cascade, rule_order
from migratrace.llm.set_join import Segments, jaccard_components
from tests.llm.helpers import ODD, WORD, ascii_lower, odd_table, shingles, words


def figures(text):
    w = words(text)
    n, repeat = len(w), [False] * len(w)
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    for i in range(n - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            repeat[i : i + 8] = [True] * 8
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(repeat)]


@pytest.mark.parametrize("chunk", [1 << 20, 16])
def test_base_figures(monkeypatch, chunk):
    monkeypatch.setattr(textscan, "_CHUNK", chunk)
    monkeypatch.setattr(textscan, "_POWERS", [])
    random.seed(3)
    for _ in range(150):
        texts = [None if random.random() < 0.1 else "".join(random.choices(["a", "b", " ", "  ", "\n", "é", "#", " a b"], k=random.randint(0, 80))) for _ in range(7)]
        assert _base(pa.array(["x", None, *texts])[2:]).tolist() == [figures(t) for t in texts]


def test_cascade_gives_the_same_verdict_in_any_order(spark):
    df = odd_table(spark)
    df = df.unionByName(df.limit(1).withColumn("doc_id", F.lit(50)).withColumn("text", F.lit("SHOUT! " * 3 + " ".join(f"WORD{i}" for i in range(40)))))
    order = rule_order(df)
    assert sorted(order) == sorted(r.name for r in RULES)
    runs = [sorted(map(tuple, quality_cascade(df, order=o).drop("rejected_by").collect()), key=str) for o in (order, order[::-1])]
    assert runs[0] == runs[1] and len(runs[0]) == len(ODD) + 1
    by_id = {r[0]: r for r in runs[0]}
    for d, t, *_ in ODD:
        if d is not None:
            assert list(by_id[d][1:6]) == figures(t)
    assert not by_id[50][7] and not by_id[50][6] and by_id[1][6]
    assert quality_cascade(df.limit(0)).collect() == []


def plain_lines(rows):
    keys = collections.defaultdict(set)
    strip = " \t\n\x0b\x0c\r"
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = ascii_lower(line.strip(strip))
            if len(k) >= 20 and d is not None:
                keys[k].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = [d is not None and len(keys.get(k := ascii_lower(x.strip(strip)), ())) >= 3 and max(keys[k]) != d for x in lines]
        text = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((d, len(lines), sum(gone), hashlib.sha256(text.encode()).hexdigest(), text if t is not None else None))
    return sorted(out, key=str)


def line_rows():
    random.seed(8)
    pool = [f"Shared line number {i} of the pool{' é' * (i % 3)}" for i in range(6)] + ["short", "", "  Shared Line NUMBER 1 of the pool é \r"]
    rows = [(i, "\n".join(random.choices(pool, k=random.randint(1, 6)) + [f"own line of document {i} here"])) for i in range(120)]
    return rows + [(None, pool[0]), (200, None), (201, ""), (7, rows[7][1]), (8, pool[0] + "\nother")]


@pytest.mark.parametrize("batch", [10_000, 3])
def test_lines_lose_all_but_the_largest_document(spark, batch):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("keep", F.lit("clash")).withColumn("fp", F.lit(0))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        maps = keep_bitmaps(df)
        got = sorted(map(tuple, line_report(df, maps).collect()), key=str)
        texts = sorted(((r["doc_id"], r["text"]) for r in apply_bitmaps(df, maps).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain_lines(rows)
    assert got == sorted((w[:4] for w in want), key=str)
    assert texts == sorted(((w[0], w[4]) for w in want), key=str)


@pytest.mark.parametrize("cuts", [1, 2, 5, 40])
def test_runs_that_cross_ranges_are_settled_together(cuts):
    """The stream over any cut of the sorted rows, with its summaries, drops what a whole pass drops."""
    random.seed(cuts)
    rows = sorted(((h, 0, d, 0, p, 9) for h in range(9) for d in random.sample(range(30), random.choice([1, 2, 3, 20])) for p in range(random.choice([1, 2]))), key=lambda r: (r[0], -r[2], r[4]))
    docs = collections.defaultdict(set)
    for h, _, d, *_ in rows:
        docs[h].add(d)
    want = {(h, d, p) for h, _, d, _, p, _ in rows if len(docs[h]) >= 3 and d != max(docs[h])}
    bounds = sorted({0, len(rows), *random.sample(range(len(rows)), cuts - 1)})
    bounds = [b for i, b in enumerate(bounds) if b in (0, len(rows)) or rows[b][:3] != rows[b - 1][:3]]
    decided, late, total = set(), [], collections.defaultdict(lambda: [0, -1])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = rows[a:b]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in own[k : k + 4]], f.type) for i, f in enumerate(line_dedup._ARROW)], schema=line_dedup._ARROW) for k in range(0, len(own), 4)]
        for out in line_dedup._stream(3)(iter(batches)):
            for r in out.to_pylist():
                if r["kind"] == line_dedup._DECIDED:
                    decided.add((r["hi"], r["doc"], r["pos"]))
                elif r["kind"] == line_dedup._OPEN:
                    late.append(r)
                else:
                    total[r["hi"]][0] += r["docs"]
                    total[r["hi"]][1] = max(total[r["hi"]][1], r["doc"])
    decided |= {(r["hi"], r["doc"], r["pos"]) for r in late if total[r["hi"]][0] >= 3 and r["doc"] != total[r["hi"]][1]}
    assert decided == want


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [i for i in sets if sets[i]]
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            n = len(x & y)
            if 100 * n >= 85 * (len(x) + len(y) - n):
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return {(i, len(sets[i]), find(i)) for i in sets}


def near_copies(n, seed):
    random.seed(seed)
    vocabulary, out = [f"w{k}" for k in range(60)], []
    while len(out) < n:
        base = [random.choice(vocabulary) for _ in range(random.choice([1, 3, 4, 9, 10, 12, 15, 20, 40, 90]))]
        for _ in range(random.choice([1, 1, 2, 3, 12])):
            t = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
                k = random.randrange(len(t)) if t else 0
                kind = random.random()
                if kind < 0.4 and t:
                    t[k] = random.choice(vocabulary)
                elif kind < 0.7:
                    t.append(random.choice(vocabulary))
                elif t:
                    t.pop(random.choice([0, -1]))
            out.append(" ".join(t).upper() if random.random() < 0.2 else " ".join(t))
    return list(enumerate(out[:n]))


@pytest.mark.parametrize(("sets", "rows"), [(1 << 11, 1 << 12), (3, 1 << 12), (6, 5)])
def test_components_match_brute_force(spark, monkeypatch, sets, rows):
    """Families in one task, families in blocks that meet in pairs, and lists that go out in parts."""
    monkeypatch.setattr(set_join, "FAMILY_SETS", sets)
    monkeypatch.setattr(set_join, "LIST_ROWS", rows)
    rows = near_copies(300, 1) + [(1000, None), (1001, ""), (1002, " \t ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x")).withColumn("n", F.lit(1))
    got = {tuple(r) for r in jaccard_components(df).collect()}
    assert got == brute_components(rows) and len({c for *_, c in got}) < 290


def test_sets_that_share_half_a_digest_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(set_join, "SHORT_BITS", 2)
    rows = near_copies(60, 9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    assert {tuple(r) for r in jaccard_components(df).collect()} == brute_components(rows)


def test_answers_derived_from_similar_sets_equal_direct_ones():
    draw = np.random.default_rng(8)
    base = draw.choice(1 << 40, 400, replace=False)
    sets = [np.sort(np.r_[draw.permutation(base)[draw.integers(0, 90) :], draw.choice(1 << 40, draw.integers(0, 90), replace=False)]) for _ in range(60)]
    sets += [np.sort(draw.choice(1 << 40, 5, replace=False)) for _ in range(5)]
    family = set_join.Family(sets)
    answers = {0: family.overlaps(0, -1, {})}
    for i in range(1, len(sets)):
        answers[i] = family.overlaps(i, i - 1, answers)
        assert answers[i].tolist() == [len(np.intersect1d(sets[i], x)) for x in sets]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            n = len(np.intersect1d(a, sets[j]))
            if 100 * n >= 85 * (len(a) + len(sets[j]) - n):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    named = family.join(np.arange(len(sets)), 85)
    assert len(set(zip(named.tolist(), root, strict=True))) == len(set(root)) == len(set(named.tolist()))


def test_components_of_odd_rows(spark):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(odd_table(spark)).collect()}
    n = len(shingles(ODD[6][1]))
    assert {(None, 1, None), (None, 0, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (5, n, 5), (6, n, 5)} <= got
    assert jaccard_components(odd_table(spark).limit(0)).collect() == []


def test_segments_meet_for_every_pair_that_can_link():
    draw, segments = np.random.default_rng(2), Segments(85)
    for _ in range(400):
        n = int(draw.integers(6, 400))
        x = np.sort(draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        away, new = int(draw.integers(0, 1 + n // 12)), int(draw.integers(0, 1 + n // 12))
        y = np.sort(np.r_[draw.permutation(x)[away:], draw.integers(0, 1 << 63, new, np.uint64) * np.uint64(2)])
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= 85 * (len(x) + len(y) - shared) and len(x) != shared:
            assert np.intersect1d(segments.keys(x)[0], segments.keys(y)[0]).size


def test_component_labels_of_chains_stars_and_copies(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
