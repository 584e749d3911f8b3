"""Lexical search, packing and the Merkle manifest against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from migratrace.llm import lexical, merkle, packing
from migratrace.llm.byte_bpe import ByteBpe
from migratrace.llm.lexical import MaskSearch, Vocabulary, ranked_search
from migratrace.llm.merkle import lower_cased_text, merkle_manifest
from migratrace.llm.packing import best_fit, pack_documents
from migratrace.llm.queries import BYTE_BPE, model_bytes
from tests.llm.helpers import ODD, SCHEMA, ascii_lower, odd_table

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(ascii_lower(text or ""))


def brute_search(docs, items, top=20):
    """Rows (item, rank, doc, score); documents and items are (key, text)."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            n = sum(c.values())
            score = 0
            for t in terms(text):
                if t in c:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((10**9 * c[t]) // (1000 * c[t] + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def rows_of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    names = ("item_id", "rank", "doc_id", "score")
    assert rows_of(ranked_search(docs, items), *names) == want
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 9)
    assert rows_of(ranked_search(docs.repartition(5), items), *names) == want


def test_search_with_odd_rows_ties_and_long_items(spark):
    rows = [*ODD, *((100 + i, "The cat. THE mat!", "en", "t", 17) for i in range(30))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("n", "terms", "counts", "key_in", "rank", "item_no")})
    long = " ".join(f"w{i}" for i in range(700))
    asked = [(1, "the cat"), (1, "mat"), (None, "end end end"), (2, None), (3, " .,"), (4, long), (5, "é \U0001f600 ▁ 1234")]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("item_in", F.lit("x"))
    got = rows_of(ranked_search(docs, items), "item_id", "rank", "doc_id", "score")
    assert got == brute_search([(r[0], r[1]) for r in rows], asked)
    assert ranked_search(docs.limit(0), items).collect() == [] and ranked_search(docs, items.limit(0)).collect() == []
    assert ranked_search(docs.where("doc_id IN (2, 3)"), items).collect() == []


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    words = [b"one", b"two", b"six", b"seven"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    at, found = Vocabulary([b"two", b"seven", b"nine"]).find(data, ends - [len(w) for w in words], ends)
    assert sorted(zip(at.tolist(), found.tolist(), strict=True)) == [(1, 0), (3, 1)]


def test_masks_that_cannot_reach_the_last_place_are_left(spark):
    docs = 4000
    draw = np.random.default_rng(3)
    rows, own = np.repeat(np.arange(docs), 3), np.tile(np.arange(3), docs)
    keep = draw.random(len(rows)) < np.array([0.9, 0.05, 0.01])[own]
    search = MaskSearch([(np.arange(3), np.array([10, 3000, 5000]))], 20)
    search.add(list(range(docs)), np.arange(docs), np.full(docs, 100), rows[keep], own[keep], np.ones(keep.sum(), np.int64))
    assert 0 < search.evaluated < search.seen


def check_packing(rows, texts, encode, capacity, end_id):
    """Pieces cover their documents, sequences are gapless and none is too long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = np.array([*encode(text or ""), end_id], "<u4")
        pieces = sorted(by_doc.pop(doc), key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // capacity)
        assert [p["start"] for p in pieces] == [sum(q["length"] for q in pieces[:i]) for i in range(len(pieces))]
        assert all(p["length"] == capacity for p in pieces[1:]) and sum(p["length"] for p in pieces) == len(ids)
        for p in pieces:
            own = ids[p["start"] : p["start"] + p["length"]]
            assert zlib.crc32(own.tobytes()) == p["ids_crc32"]
            assert "ids" not in p or p["ids"] == own.tolist()
    assert not by_doc
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_buffer(model_bytes(BYTE_BPE))
    return lambda text: own.encode(text, add_special_tokens=False).ids


def test_packing_equals_the_library_and_is_as_tight_as_one_best_fit(spark, tokenizer, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(9, "doc_id")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    monkeypatch.setattr(packing, "FAN", 2)  # 9, 5, 3, 2 and 1 tasks of about 100 documents and fewer bins
    rows = [r.asDict() for r in pack_documents(docs, model_bytes(BYTE_BPE), with_ids=True).collect()]
    used = check_packing(rows, texts, tokenizer, 1024, 2)
    least = len(set(best_fit(np.array([r["length"] for r in rows]), 1024)[0].tolist()))
    assert used <= 1.02 * least


def test_packing_of_odd_rows_and_small_sequences(spark, tokenizer, monkeypatch):
    odd = odd_table(spark).where("doc_id IS NOT NULL AND doc_id <> 5").withColumns({c: F.lit("x") for c in ("item", "bin", "place", "fill", "piece")})
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    monkeypatch.setattr(packing, "CHUNK", 50)
    rows = [r.asDict() for r in pack_documents(odd, model_bytes(BYTE_BPE), capacity=7, end_id=50256).collect()]
    check_packing(rows, texts, tokenizer, 7, 50256)
    all_odd = pack_documents(odd_table(spark), model_bytes(BYTE_BPE)).collect()
    assert sum(r["piece"] == 0 for r in all_odd) == len(ODD)
    assert len({(r["sequence_id"], r["offset"]) for r in all_odd}) == len(all_odd)
    assert pack_documents(odd.limit(0), model_bytes(BYTE_BPE)).collect() == []


def test_words_of_byte_bpe_are_the_library_s(tokenizer):
    own = ByteBpe(model_bytes(BYTE_BPE))
    draw = random.Random(4)
    parts = [" ", "  ", "\n", "\t ", "don't", "we'll", "ñandú", "Ünder.", "a,b", "42", "²", "Ⅷ", "\x1c", "\x00", " ", "　", "中文", "\U0001f600", "<|endoftext|>", "x" * 40, "...", "'s", "é!?"]
    texts = ["", " ", " lead", "trail ", *("".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(1, 30))) for _ in range(400))]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tokenizer(text), repr(text)


def test_best_fit_takes_the_tightest_bin():
    sizes = np.array([6, 5, 4, 3, 3, 2, 10, 1])
    bins, places = best_fit(sizes, 10)
    fill = np.bincount(bins, weights=sizes, minlength=len(sizes))
    assert fill.max() <= 10 and (fill > 0).sum() == 4 and bins[6] == 6 and bins[2] == 0
    assert all(places[i] == 0 for i in set(bins.tolist()))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    """Rows (doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""

    def part(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
        return levels

    def sides(levels, i):
        out = []
        for level in levels[:-1]:
            run = i // 16 * 16
            out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
            i //= 16
        return out

    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((sha("".join(map(part, r))), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = tree([leaf for leaf, _ in by_source[s]])
    over = tree([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (leaf, r) in enumerate(by_source[s]):
            way = sides(trees[s], i) + sides(over, place)
            shown = list(r)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                shown[4] = ascii_lower(r[4])
            cur = sha("".join(map(part, shown)))
            for left, right in way:
                cur = sha(left + cur + right)
            out.append((r[0], leaf, trees[s][-1][0], over[-1][0], sha("".join(a + b for a, b in way)), cur, cur == over[-1][0]))
    return sorted(out, key=repr)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest(docs, **options):
    return rows_of(merkle_manifest(docs, presented={"text": lower_cased_text(docs)}, **options), *MANIFEST)


def stored(docs):
    return [tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in docs.collect()]


def test_manifest_equals_brute_force_at_every_depth(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # a third of all rows in one source, and more sources than one run
    docs = docs.unionByName(docs.withColumns({"doc_id": F.col("doc_id") + 1000, "source": F.lit("hot")}))
    docs = docs.unionByName(docs.withColumns({"doc_id": F.col("doc_id") + 5000, "source": F.concat(F.lit("é"), F.col("doc_id") % 40)}))
    want = brute_manifest(stored(docs))
    assert {w[-1] for w in want} == {True, False}
    for depth in (1, 3):  # superblocks of 16 leaves: several rounds; and of 4096
        assert manifest(docs, depth=depth) == want
    assert manifest(docs.repartition(7)) == want


def test_manifest_of_odd_rows(spark):
    odd = odd_table(spark).withColumns({c: F.lit("x") for c in ("tree", "idx", "start", "home", "block", "leaf", "shown")})
    assert manifest(odd) == brute_manifest(stored(odd))
    one = odd.where("doc_id = 7")
    assert manifest(one) == brute_manifest(stored(one)) and manifest(one)[0][4] == sha("")
    assert manifest(odd.limit(0)) == []
    words = odd.select(F.concat(F.lit("k"), "doc_id").alias("doc_id"), "source", "lang", "n_chars", "text").where("doc_id IS NOT NULL")
    assert {r["verified"] for r in merkle_manifest(words).collect()} == {True}
    assert merkle.WIDTH == 16
