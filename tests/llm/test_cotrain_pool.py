"""The exchange of pseudo-labels over all unlabelled documents."""

from __future__ import annotations

import random

import numpy as np

from migratrace.llm import cotrain
from migratrace.llm.cotrain import Rows, fit_quality_model, score_documents


def corpus():
    """8,000 short documents, a third of them junk, the first 1,000 labelled."""
    draw, docs, labels = random.Random(4), [], []
    for i in range(8_000):
        if i % 3 == 0:
            text = " ".join(f"BUY{draw.randrange(40)}$$" for _ in range(draw.randrange(15, 25)))
        else:
            text = " ".join(f"word{draw.randrange(400)}" for _ in range(draw.randrange(30, 50)))
        docs.append((i, text, "en", "web" if i % 3 == 0 else "books", len(text)))
        if i < 1_000:
            labels.append((i, int(i % 3 != 0), 0))
    return docs, labels


def tables(spark, docs, labels):
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_all_unlabelled_documents_take_part_and_each_is_handed_over_once(spark, monkeypatch):
    docs, labels = tables(spark, *corpus())
    rounds, plain = [], cotrain._handed_over

    def watched(pool, past, turn):
        found = plain(pool, past, turn)
        rounds.append((pool, turn, found))
        return found

    monkeypatch.setattr(cotrain, "_handed_over", watched)
    monkeypatch.setattr(cotrain, "_judged", lambda model, rows, y: np.zeros(3))
    assert fit_quality_model(docs, labels).round == len(rounds) > 1
    pool = rounds[0][0].toArrow().combine_chunks()
    assert pool.num_rows == 8_000
    rows, sampled = Rows.read(pool), pool.column("sampled").to_numpy()
    assert sampled.sum() == 1_000
    given = np.repeat(sampled, 4).reshape(-1, 2, 2)
    for _, turn, (counts, total, cells) in rounds:
        handed = cotrain._offered(cotrain._logits(turn.text, turn.meta, rows), given) >= turn.least
        assert not (handed.any(axis=3) & given).any()
        given = given | handed.any(axis=3)
        assert total.tolist() == handed[:, 1].sum(axis=0).tolist()
        assert cells.sum(axis=2).tolist() == handed[:, 0].sum(axis=0).tolist()
        for flaw, label in np.ndindex(2, 2):
            want = np.zeros(cotrain.WORD_BUCKETS)
            for i in np.flatnonzero(handed[:, 1, flaw, label]):
                want[rows.words[rows.bounds[i] : rows.bounds[i + 1]]] += 1
            assert (want == counts[flaw, label]).all()
    assert (given & ~sampled[:, None, None]).sum() > 0


def toxic_corpus():
    """6,000 documents: a ninth holds an insult, a seventh is junk that its source shows; 3,000 labels."""
    draw, docs, labels = random.Random(5), [], []
    for i in range(6_000):
        words = [f"word{draw.randrange(3_000)}" for _ in range(draw.randrange(20, 90))]
        if i % 7 == 0:
            words = [f"{w}$$" for w in words]
        if i % 9 == 0:
            words[draw.randrange(len(words))] = f"insult{draw.randrange(6)}"
        text = " ".join(words)
        docs.append((i, text, "en", "spam" if i % 7 == 0 and i % 5 else f"site{i % 11}", len(text)))
        if i % 2:
            labels.append((i, int(i % 7 != 0), int(i % 9 == 0)))
    return docs, labels


def test_exchange_keeps_no_more_toxic_or_junk_documents(spark):
    docs, labels = tables(spark, *toxic_corpus())
    kept = []
    for rounds in (0, 4):
        rows = score_documents(docs, fit_quality_model(docs, labels, rounds=rounds)).where("doc_id % 2 = 0 AND kept").collect()
        ids = {r["doc_id"] for r in rows}
        every = range(0, 6_000, 2)
        of = {"toxic": [i for i in every if i % 9 == 0], "junk": [i for i in every if i % 7 == 0], "good": [i for i in every if i % 9 and i % 7]}
        kept.append({k: sum(i in ids for i in v) / len(v) for k, v in of.items()})
    assert kept[1]["toxic"] <= kept[0]["toxic"] + 0.01 and kept[1]["junk"] <= kept[0]["junk"] + 0.01, kept
    assert kept[1]["toxic"] < 0.05 and kept[1]["junk"] < 0.05 and kept[1]["good"] > 0.97, kept


def test_metadata_view_sees_no_text(spark):
    docs, labels = tables(spark, *toxic_corpus())
    model = fit_quality_model(docs, labels, rounds=0)
    rows = [(i, text, "en", "site3", 300) for i, text in enumerate(["insult1 insult2", "word1 word2\nword3", "A$$ B$$ C$$"])]
    rows += [(9, None, None, None, None), (9, "", "en", "site3", 300), (None, "word5", "en", "site3", 300)]
    odd, _ = tables(spark, rows, [(1, 1, 1)])
    found = score_documents(odd, model).collect()
    assert len(found) == 6
    assert len({r["meta_score"] for r in found if r["text_score"]}) == 1
    assert [r["kept"] for r in found if not r["text_score"]] == [False, False]


def test_a_view_is_trusted_only_where_held_out_labels_bear_it_out():
    y = np.zeros((400, 2), int)
    y[:, 0] = np.arange(400) % 10 > 0  # a tenth has the first flaw
    y[:, 1] = np.arange(400) % 2
    sure = np.full((400, 2, 2, 2), -np.inf)
    sure[:, 0, 1, 1] = np.where(y[:, 1] == 1, 5.0, 3.5)  # right above 3.5, blind below
    sure[:, 1, 0, 1] = 4.0  # sees nothing, right nine times in ten
    least = cotrain._trusted(sure, y)
    assert least[0, 1, 1] == 5.0
    assert np.isinf(least[1]).all() and np.isinf(least[0, 0]).all() and np.isinf(least[0, 1, 0])
