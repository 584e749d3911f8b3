"""The near-duplicate stage of the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
from migratrace.llm.lang_id import fit_language_model, identify
from tests.llm.helpers import ascii_lower, words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def five_words(text):
    w = words(ascii_lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    """For each row the rows reachable by links of 80 % or more of five-word shingles, itself included."""
    sets = [five_words(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def stage(spark, rows):
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    return out.select("doc_id", "text").collect()


def planted():
    """Texts with near copies on both sides of 80 %: words appended, words exchanged, short texts."""
    draw, rows = random.Random(5), []
    for base in range(30):
        text = [f"b{base}w{draw.randrange(10**6)}" for _ in range(200)]
        rows.append((base, " ".join(text)))
        rows.append((100 + base, " ".join(text + [f"more{base}x{i}" for i in range(30 + base)])))
        other = list(text)
        for i in range(base % 6 + 1):
            other[10 + 30 * i] = f"new{base}"
        rows.append((200 + base, " ".join(other)))
    for n in range(3, 12):
        rows += [(300 + n, " ".join(f"s{n}q{i}" for i in range(n))), (400 + n, " ".join(f"s{n}q{i}" for i in range(n + 1)))]
    draw.shuffle(rows)
    return rows


def test_near_copies_of_five_words_and_80_percent_are_linked(spark):
    rows = planted()
    between = sum(
        80 <= 100 * len(a & b) / len(a | b) < 85
        for base in range(30)
        for a in [five_words(dict(rows)[base])]
        for b in [five_words(dict(rows)[100 + base])]
    )
    assert between >= 10
    least = {}
    for (d, _), g in zip(rows, brute_groups(rows), strict=True):
        least[g] = min(d, least.get(g, d))
    assert sorted(r["doc_id"] for r in stage(spark, rows)) == sorted(least.values())


def test_texts_under_one_id_are_kept_and_dropped_one_by_one(spark):
    draw = random.Random(7)
    for turn in range(3):
        base, unique, other = (" ".join(f"t{turn}{part}{draw.randrange(10**6)}" for _ in range(80)) for part in "abc")
        near = base + " one more word"
        rows = [(3, base), (7, near), (7, unique), (7, unique), (None, near), (None, other), (9, None), (9, None), (8, "")]
        draw.shuffle(rows)
        got = sorted(((r["doc_id"], r["text"]) for r in stage(spark, rows)), key=repr)
        assert got == sorted([(3, base), (7, unique), (None, other), (9, None), (8, "")], key=repr)


def test_the_kept_texts_of_repeated_ids_equal_brute_force(spark):
    rows = [(d // 3, t) for d, t in planted()]
    distinct = sorted(set(rows), key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    first = {}
    for row, g in zip(distinct, brute_groups(distinct), strict=True):
        first.setdefault(g, row)
    assert sorted((r["doc_id"], r["text"]) for r in stage(spark, rows)) == sorted(first.values())


def test_line_stage_equals_brute_force(spark):
    draw, rows = random.Random(3), []
    shared = [f"Shared line number {i} of this corpus" for i in range(12)]
    for d in range(60):
        lines = [draw.choice(shared) if draw.random() < 0.5 else f"  own {d} {draw.randrange(100)} words of this document" for _ in range(draw.randrange(1, 7))]
        rows.append((d, "\n".join(x.upper() if draw.random() < 0.2 else x for x in lines)))
    rows += [(100, None), (101, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)

    def line_key(line):
        return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(line_key(line), set()).add(d)
    lost = {k: max(h) for k, h in holders.items() if len(k) >= 20 and len(h) >= 3}
    want = [(d, t if t is None else "\n".join(x for x in t.split("\n") if lost.get(line_key(x), d) == d)) for d, t in rows]
    out = corpus_pipeline.line_dedup(spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["text"] or "", r["n_chars"]) for r in out) == sorted((d, t or "", len(t or "")) for d, t in want)


def test_mix_stage_takes_the_words_of_its_documents_in_order(spark):
    draw = random.Random(11)
    rows = [(d, " ".join(f"d{d}w{i}" for i in range(draw.randrange(0, 400))), f"s{d % 4}") for d in range(80)]
    docs = spark.createDataFrame([(d, t, "en", s, len(t)) for d, t, s in rows], SCHEMA)
    texts, taken, size = {d: words(t) for d, t, _ in rows}, {}, {}
    for r in corpus_pipeline.mixing(spark, docs, SF).collect():
        got, own = words(r["text"]), iter(texts[r["doc_id"]])
        assert got and all(w in own for w in got)
        taken[r["source"]] = taken.get(r["source"], 0) + len(got)
    for d, _, s in rows:
        size[s] = size.get(s, 0) + len(texts[d])
    # 150 % of all words by weights 5, 2, 1, 5; no source above twice its size, the rest reshared
    weights, open_, target = dict(zip(sorted(size), (5, 2, 1, 5), strict=True)), set(size), {}
    while True:
        rest = 1.5 * sum(size.values()) - sum(target.values())
        over = {s for s in open_ if rest * weights[s] / sum(weights[x] for x in open_) > 2 * size[s]}
        if not over:
            break
        target |= {s: 2 * size[s] for s in over}
        open_ -= over
    target |= {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
    assert all(abs(taken[s] - target[s]) <= 2 for s in size)


def test_encoding_stage_equals_the_library(spark):
    import sentencepiece
    from migratrace.llm.queries import model_path

    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0)], docs.schema))
    for r in corpus_pipeline.sentencepiece(spark, docs, SF).join(docs.select("doc_id", "text"), "doc_id").collect():
        ids = library.encode(r["text"] or "") + [library.eos_id()]
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_language_stage_drops_what_the_model_rejects(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, "12 34 --", "en", "s", 8), (-2, None, "en", "s", 0), (-3, "", "en", "s", 0)], docs.schema)
    both = docs.unionByName(odd)
    model = fit_language_model(both)
    rejected = {r["doc_id"] for r in identify(both.select("doc_id", "text"), model).where("rejected").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, both, SF).collect()}
    assert kept == {r["doc_id"] for r in both.select("doc_id").collect()} - rejected and {-1, -2, -3} <= rejected
    assert len(kept) >= 0.98 * docs.count()
