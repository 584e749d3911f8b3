"""Text preparation over documents, pages and orders."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import functions as F

from migratrace.functions import text as X
from migratrace.operators.embed import embed, hashed_embedding
from migratrace.operators.textprep import lemmatize, prepare_text
from migratrace.registry.tickets import table

_LETTERS = "aeionrst"


def clean_text_pages(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", X.clean_text(F.concat_ws(" ", F.col("html"), F.col("url"), F.lit("[URL][IP] [PHONE] 10.0.0.1"))).alias("Clean_Text")
    )


def clean_text_documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.clean_text(F.col("text")).alias("Clean_Text"))


def error_codes(spark, folder):
    """Error texts derived from every order; numbers of all lengths occur."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(
        F.lit("Job ERR-"), key, F.lit(" raised Exception, err_"), customer, F.lit(" Error Code "), customer,
        F.lit(" ERR"), F.pmod(key, F.lit(7)), F.when(F.pmod(key, F.lit(2)) == 0, F.lit(" Traceback exception")).otherwise(F.lit("")),
    )
    return table(spark, folder, "orders").select("o_orderkey", X.error_codes(text).alias("Extracted_Errors"))


def lemma_tokens(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.lower("text").alias("Clean_Text"))
    return lemmatize(docs, key="doc_id").select("doc_id", "Lemma_Text")


def _noun_lemmas(spark, folder):
    """A dictionary from the documents themselves: words in -tion with and without plural s."""
    words = (
        table(spark, folder, "documents")
        .select(F.explode(F.array_distinct(X.alpha_tokens(F.lower("text")))).alias("word"))
        .where(F.col("word").endswith("tion"))
        .distinct()
    )
    return words.select("word", F.expr("substring(word, 1, length(word) - 3)").alias("lemma"))


def lemma_dictionary(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.lower("text").alias("Clean_Text"))
    return lemmatize(docs, key="doc_id", lemmas=_noun_lemmas(spark, folder)).select("doc_id", "Lemma_Text")


def prepared_text(spark, folder):
    """Full, clean and error text of conversation turns as tickets."""
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn",
        F.concat(F.lit("Glassrun ERR-4711 "), F.col("role")).alias("Short_Description"),
        F.when(F.col("role") != "system", F.col("text")).alias("Description_Text"),
        F.lit(None).cast("string").alias("Resolution_Notes"),
    )
    return prepare_text(turns).select("conv_id", "turn", "Clean_Text", "Extracted_Errors", F.md5("Full_Text").alias("Full_Hash"))


def _letter_share_encoder():
    def encode(texts: Sequence[str]) -> np.ndarray:
        return np.array([[t.count(letter) for letter in _LETTERS] for t in texts], dtype=np.float32)

    return encode


def embedded_documents(spark, folder):
    """The encoder hook with a letter-counting encoder, unfolded to one column per letter."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("Clean_Text"))
    vectors = embed(docs, _letter_share_encoder)
    return vectors.select("doc_id", *[F.col("Embedding")[i].cast("long").alias(f"n_{c}") for i, c in enumerate(_LETTERS)])


def hashed_documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("Clean_Text"))
    return hashed_embedding(docs).select("doc_id", "Embedding")


QUERIES = {
    "clean_text_pages": clean_text_pages,
    "clean_text_documents": clean_text_documents,
    "error_codes": error_codes,
    "lemma_tokens": lemma_tokens,
    "lemma_dictionary": lemma_dictionary,
    "prepared_text": prepared_text,
    "embedded_documents": embedded_documents,
    "hashed_documents": hashed_documents,
}


def clean_sql(c: str) -> str:
    out = f"coalesce({c}, '')"
    for pattern in (X.TAG, X.LINK, X.PLACEHOLDER, X.DOTTED_QUAD):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"trim(regexp_replace(lower({out}), '{X.SPACE}+', ' ', 'g'))"


def errors_sql(c: str) -> str:
    return f"array_to_string(list_sort(list_distinct(regexp_extract_all(lower({c}), '{X.ERROR_CODE}'))), ' ')"


def tokens_sql(c: str) -> str:
    return f"""list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+'),
  lambda x: regexp_full_match(x, '\\p{{L}}+') AND x NOT IN ({X.stop_list_sql()}))"""


_TOKENS = tokens_sql("text")
_FULL = """'Glassrun ERR-4711 ' || role || ' ' || CASE WHEN role <> 'system' THEN coalesce(text, '') ELSE '' END || ' '"""

SQL = {
    "clean_text_pages": f"""SELECT page_id, {clean_sql("html || ' ' || url || ' [URL][IP] [PHONE] 10.0.0.1'")} AS "Clean_Text" FROM pages""",
    "clean_text_documents": f'SELECT doc_id, {clean_sql("text")} AS "Clean_Text" FROM documents',
    "error_codes": f"""SELECT o_orderkey, {errors_sql("'Job ERR-' || o_orderkey || ' raised Exception, err_' || o_custkey || ' Error Code ' || o_custkey || ' ERR' || (o_orderkey % 7) || CASE WHEN o_orderkey % 2 = 0 THEN ' Traceback exception' ELSE '' END")} AS "Extracted_Errors" FROM orders""",
    "lemma_tokens": f"""SELECT doc_id, array_to_string({_TOKENS}, ' ') AS "Lemma_Text" FROM documents""",
    "lemma_dictionary": f"""SELECT doc_id, array_to_string(list_transform({_TOKENS},
        lambda x: CASE WHEN suffix(x, 'tion') THEN left(x, length(x) - 3) ELSE x END), ' ') AS "Lemma_Text" FROM documents""",
    "prepared_text": f"""SELECT conv_id, turn, {clean_sql(_FULL)} AS "Clean_Text", {errors_sql(_FULL)} AS "Extracted_Errors",
        md5({_FULL}) AS "Full_Hash" FROM conversations""",
    "embedded_documents": "SELECT doc_id, "
    + ", ".join(f"CAST(length(text) - length(replace(text, '{c}', '')) AS BIGINT) AS n_{c}" for c in _LETTERS)
    + " FROM documents",
}
