"""The registered query of each operator, and the SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from migratrace.llm.common import new_folder, table
from migratrace.llm.cotrain import fit_quality_model, score_documents
from migratrace.llm.counts import token_counts
from migratrace.llm.lang_id import fit_language_model, identify
from migratrace.llm.lexical import ranked_search
from migratrace.llm.line_dedup import keep_bitmaps, line_report
from migratrace.llm.merkle import lower_cased_text, merkle_manifest
from migratrace.llm.mixing import mix_report
from migratrace.llm.packing import pack_documents
from migratrace.llm.pieces import encode_documents
from migratrace.llm.quality_rules import quality_cascade
from migratrace.llm.set_join import jaccard_components
from migratrace.llm.topk import top_inner_products
from migratrace.llm.warc import archive_report, write_archive

MODEL = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def model_bytes(name: str = MODEL) -> bytes:
    with open(model_path(name), "rb") as f:
        return f.read()


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_folder(spark, "warc")
    write_archive(table(spark, folder, "pages"), archive)
    return archive_report(spark, archive)


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(table(spark, folder, "documents"), model_path(), new_folder(spark, "token-counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_report(table(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cascade(table(spark, folder, "documents")).drop("rejected_by")


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_documents(docs, fit_quality_model(docs, table(spark, folder, "labels")))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_report(docs, keep_bitmaps(docs))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("n_tokens", "ids_sha256", "decoded_sha256", "covered")
    return encode_documents(table(spark, folder, "documents"), model_bytes(), outputs=columns)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit_language_model(docs.where(~held_out))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_inner_products(vectors.where(F.col("vec_id") % 50 == 0), vectors)


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), model_bytes(BYTE_BPE))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle_manifest(docs, presented={"text": lower_cased_text(docs)})


_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"

_OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner
  FROM pages
)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
       translate(list_aggregate(list_transform([1, 11, 21, 31], lambda i: to_base(CAST('0x' || substr(h, i, 10) AS BIGINT), 32, 8)), 'string_agg', ''),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM p
"""

_OP2_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM w
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b USING (g)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a
)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(other) FROM r WHERE r.doc_id = s.doc_id) AS component_id FROM s
"""

_OP5_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 7, 0) + 1)) AS i FROM t)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), tops AS (
  SELECT doc_id, max(c) AS top, count(*) AS different
  FROM (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(w) AS x FROM t) GROUP BY doc_id, x) GROUP BY doc_id
), f AS (
  SELECT t.doc_id, len(w) AS n_words, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_n, length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower_n,
         length(regexp_replace(text, '\P{{L}}', '', 'g')) AS letters, top, different
  FROM t LEFT JOIN covered USING (doc_id) LEFT JOIN tops USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 100 * n_dup_lines > 40 * lines OR 100 * upper_n > 30 * (upper_n + lower_n) OR 100 * letters < 50 * word_chars
            OR 100 * different < 20 * n_words OR 100 * top > 30 * n_words) AS kept
FROM b
"""

_OP7_SQL = rf"""
WITH l AS (
  SELECT doc_id, pos, lines[pos] AS line,
         translate(regexp_replace(lines[pos], '^{_BLANK}+|{_BLANK}+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM l LEFT JOIN shared USING (k) GROUP BY doc_id
"""

_OP10_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x
  FROM benchmark
), c AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM t WHERE len(w) > 0
), e AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS x FROM t
), f AS (
  SELECT doc_id, n, x, count(*) AS tf FROM e GROUP BY doc_id, n, x
), d AS (
  SELECT x, count(*) AS df FROM f GROUP BY x
), s AS (
  SELECT item_id, doc_id,
         sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS score
  FROM q JOIN f USING (x) JOIN d USING (x), c GROUP BY item_id, doc_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""

_OP13_SQL = """
WITH RECURSIVE bits AS (
  SELECT doc_id, list_reduce(
           [4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
           lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), d AS (
  SELECT doc_id, source, text, coalesce(xor(c, 4294967295) % 5 = 0, false) AS tampered, lang, n_chars
  FROM documents LEFT JOIN bits USING (doc_id)
), h AS (
  SELECT doc_id, source, tampered,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM d
), l AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || CASE WHEN tampered THEN coalesce(octet_length(encode(low)) || ':' || low, '-') ELSE coalesce(octet_length(encode(text)) || ':' || text, '-') END) AS shown
  FROM h
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l
), tree AS (
  SELECT source, 0 AS level, i, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (n + 15) // 16 FROM tree WHERE n > 1 GROUP BY source, level, i // 16, n
), subroots AS (
  SELECT source, level AS depth, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM tree WHERE n = 1
), over_ AS (
  SELECT 0 AS level, i, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (n + 15) // 16 FROM over_ WHERE n > 1 GROUP BY level, i // 16, n
), inner_sides AS (
  SELECT source, level, i, coalesce(string_agg(digest, '' ORDER BY i) OVER (PARTITION BY source, level, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY i) OVER (PARTITION BY source, level, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tree WHERE n > 1
), outer_sides AS (
  SELECT level, i, coalesce(string_agg(digest, '' ORDER BY i) OVER (PARTITION BY level, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY i) OVER (PARTITION BY level, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM over_ WHERE n > 1
), sides AS (
  SELECT t.source, t.i, level, before, after FROM inner_sides t
  UNION ALL
  SELECT t.source, NULL, t.depth + level, before, after FROM subroots t, outer_sides s
  WHERE s.i = t.i >> CAST(4 * s.level AS BIGINT)
), walk AS (
  SELECT doc_id, source, i, i AS at, leaf, shown, shown AS cur, '' AS proof, 0 AS level FROM leaves
  UNION ALL
  SELECT w.doc_id, w.source, w.i, w.at // 16, w.leaf, w.shown, sha256(s.before || w.cur || s.after), w.proof || s.before || s.after, w.level + 1
  FROM walk w JOIN sides s ON s.source IS NOT DISTINCT FROM w.source AND s.level = w.level AND (s.i = w.at OR s.i IS NULL)
), last AS (
  SELECT * FROM (SELECT *, max(level) OVER () AS top FROM walk) QUALIFY row_number() OVER (PARTITION BY source, i ORDER BY level DESC) = 1
)
SELECT w.doc_id, w.leaf, t.digest AS subroot, r.digest AS root, sha256(w.proof) AS proof_sha256, w.cur AS folded_root, w.cur = r.digest AS verified
FROM last w JOIN subroots t ON t.source IS NOT DISTINCT FROM w.source, (SELECT digest FROM over_ WHERE n = 1) r
"""

QUERIES = {
    "op1_warc": op1_warc,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_topk": op10_topk,
    "op11_lexical_search": op11_lexical_search,
    "op12_packing": op12_packing,
    "op13_merkle": op13_merkle,
}
SQL: dict[str, str] = {
    "op1_warc": _OP1_SQL,
    "op2_jaccard_join": _OP2_SQL,
    "op5_quality_rules": _OP5_SQL,
    "op7_line_dedup": _OP7_SQL,
    "op10_topk": _OP10_SQL,
    "op11_lexical_search": _OP11_SQL,
    "op13_merkle": _OP13_SQL,
}
