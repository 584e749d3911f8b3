"""Archive round trip, token counts through the cache, offset-preserving encoding."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from migratrace.llm import pieces
from migratrace.llm.counts import token_counts
from migratrace.llm.pieces import CharacterMap, PieceCodec, decode_ids, encode_documents
from migratrace.llm.queries import model_bytes, model_path
from migratrace.llm.warc import archive_report, export_warc, read_records, write_archive
from tests.llm.helpers import ODD, odd_table

PAGES = [(1, "http://a", "x"), (2, "http://b\r\nc", "x"), (3, None, None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1"), (None, "u", "x"), (2, "http://b", "x")]


def b32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def test_archive_gives_back_every_record(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("key", F.lit(2))
    write_archive(pages, f"{tmp_path}/a")
    got = sorted(map(tuple, archive_report(spark, f"{tmp_path}/a").collect()), key=str)
    want = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        owner = max((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        first = page == owner
        want.append((page, len(raw), b32(raw), "response" if first else "revisit", None if first else owner))
    assert got == sorted(want, key=str)
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == 3
    for r in read_records(spark, f"{tmp_path}/a").collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert rest[size:] == b"\r\n\r\n" and rest[:size].endswith(bytes(r["payload"]) if r["record_type"] == "response" else b"\r\n\r\n")
    export_warc(spark, f"{tmp_path}/a", f"{tmp_path}/w")
    files = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    assert files.count(b"WARC-Record-ID") == len(PAGES) and sum(len(r["record"]) for r in read_records(spark, f"{tmp_path}/a").collect()) == len(files)


def test_small_payloads_are_all_responses_and_empty_tables_work(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_archive(pages, f"{tmp_path}/a", min_bytes=2)
    assert {r["record_type"] for r in archive_report(spark, f"{tmp_path}/a").collect()} == {"response"}
    write_archive(pages.limit(0), f"{tmp_path}/b")
    assert archive_report(spark, f"{tmp_path}/b").collect() == []


def test_a_damaged_payload_stops_the_read(spark, tmp_path):
    write_archive(spark.createDataFrame(PAGES[:1], "page_id long, url string, html string"), f"{tmp_path}/a")
    spark.read.parquet(f"{tmp_path}/a/payloads").select("address", F.lit(b"y").alias("payload")).write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/records").write.parquet(f"{tmp_path}/b/records")
    with pytest.raises(Exception, match="damaged"):
        read_records(spark, f"{tmp_path}/b").collect()


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_counts_match_the_library_and_come_from_the_cache(spark, tmp_path, name):
    path, cache = public_tokenizers.path(name), f"{tmp_path}/cache"
    got = sorted(map(tuple, token_counts(odd_table(spark), path, cache).collect()), key=str)
    if name.endswith(".model"):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(library.encode(t))
    else:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    assert got == sorted(((d, len((t or "").encode()), count(t or "")) for d, t, *_ in ODD), key=str)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t, *_ in ODD})
    # stored counts are used, and only what is missing is added
    changed = stored.select("content", "tokenizer", (F.col("n_tokens") + 1000).alias("n_tokens"))
    changed.write.parquet(f"{tmp_path}/other")
    more = odd_table(spark).unionByName(odd_table(spark).limit(1).withColumn("text", F.lit("new")).withColumn("doc_id", F.lit(99)))
    again = {tuple(r) for r in token_counts(more, path, f"{tmp_path}/other").collect()}
    assert {(d, b, n + 1000) for d, b, n in got} | {(99, 3, count("new"))} == again
    assert spark.read.parquet(f"{tmp_path}/other").count() == stored.count() + 1
    assert token_counts(odd_table(spark).limit(0), path, f"{tmp_path}/none").collect() == []


def test_encoding_is_the_librarys_and_spans_tile_the_text(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    rows = encode_documents(odd_table(spark), model_bytes()).collect()
    assert len(rows) == len(ODD)
    texts = {}
    for d, t, *_ in ODD:
        texts.setdefault(d, []).append(t or "")
    for r in rows:
        ids = [i for i in ([*library.encode(t), 2] for t in texts[r["doc_id"]]) if i == r["ids"]]
        text = next(t for t in texts[r["doc_id"]] if [*library.encode(t), 2] == r["ids"])
        assert ids and r["decoded"] == library.decode(r["ids"]) and r["covered"] == len(text.encode())
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["starts"] == [0, *r["ends"]][: len(r["ends"])] and (r["ends"] or [0])[-1] == len(text.encode())
    ids = spark.createDataFrame([(1, [413, 2]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in decode_ids(ids, model_bytes()).collect()} == {1: library.decode([413, 2]), 2: None, 3: ""}
    assert encode_documents(odd_table(spark).limit(0), model_bytes()).collect() == []


def test_words_apart_give_the_ids_of_the_whole(monkeypatch):
    codec = PieceCodec(model_bytes())
    assert codec.by_words
    random.seed(1)
    parts = ["a", " ", "  ", "\n", "▁", "é", "\U0001f600", "the", "<s>", "\x00", "</s>", "\t", " w"]
    for stretch in (1 << 20, 7):
        monkeypatch.setattr(pieces, "STRETCH", stretch)
        for _ in range(3000):
            text = "".join(random.choices(parts, k=random.randint(0, 20)))
            ids = codec.library.encode(text)
            assert codec.encode(text) == ids and codec.count_all([text]) == [len(ids)]
            starts, ends = codec.spans(text, ids)
            fast = next(codec.spans_all([text], [ids]))
            assert (fast[1] == ends).all() and (fast[0] == starts).all()


def test_compiled_character_map_replaces_the_longest_prefix():
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    compiled = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    for text in ("ﬁ ½ é ｱﾊﾟｰﾄ Å", "①②", "plain", "", "\U0001f600ﬀ"):
        out, source = compiled.apply(text.encode())
        assert out.decode().split() == library.normalize(text).replace("▁", " ").split()
        assert len(source) == len(out) + 1 and source[-1] == len(text.encode()) and (np.diff(source) >= 0).all()
    out, source = compiled.apply("xﬁy".encode())
    assert (out, source.tolist()) == (b"xfiy", [0, 1, 1, 4, 5])
