"""A corpus from raw documents to token ids: language, shared lines, near duplicates, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the documents of the next.  All stages but the last
return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from migratrace.llm.common import new_folder, table
from migratrace.llm.lang_id import fit_language_model, identify
from migratrace.llm.line_dedup import apply_bitmaps, keep_bitmaps
from migratrace.llm.mixing import mix_documents
from migratrace.llm.pieces import encode_documents
from migratrace.llm.queries import model_bytes
from migratrace.llm.set_join import jaccard_components

#: Near copies of the stage: word shingles of this length, and the least percentage of them that two texts share.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that clash with nothing, and the new name of each column."""
    new = {n: f"c{i}" for i, n in enumerate(docs.columns)}
    return docs.toDF(*new.values()), new


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not recognised: null texts, texts without a letter, scores under the threshold.

    The model is fitted on the documents' own labels, about TRAIN_ROWS each; without any label nothing can be
    recognised, and only texts that are null or hold no letter go.
    """
    model = fit_language_model(docs)
    plain, names = _plain(docs)
    found = identify(plain, model, text=names["text"])
    rejected = F.col("rejected") if model else ~F.coalesce(F.col(names["text"]).rlike(r"\p{L}"), F.lit(False))
    return found.where(~rejected).select(*(F.col(c).alias(n) for n, c in names.items()))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that three documents or more share, but for the largest id; n_chars follows the text.

    A document all of whose lines go keeps its row, with an empty text.
    """
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    kind = docs.schema["n_chars"].dataType
    changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
    return kept.select(*(changed.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: that with the smallest id, and of its texts the first by digest.

    Near duplicates share NEAR_PERCENT of their NEAR_SHINGLE-word shingles; op2's own contract binds only op2.
    A document is a distinct pair of id and text, so different texts under one
    id are compared, kept and dropped one by one; a missing id comes after all
    others.  Rows that repeat id and text are one document.  Null texts and
    texts without words are in no group; each such id and text keeps one row.
    """
    plain, names = _plain(docs)
    key, text = F.col(names["doc_id"]), F.col(names["text"])
    row = F.struct(key.isNull().alias("missing"), key.alias("id"), F.sha2(text.cast("binary"), 256).alias("digest"))
    keyed = plain.withColumn("row_key", row)
    groups = jaccard_components(keyed.select("row_key", text.alias("text_in")), key="row_key", text="text_in", size=NEAR_SHINGLE, percent=NEAR_PERCENT)

    def code(c: str) -> Column:
        parts = (F.col(f"{c}.missing").cast("string"), F.col(f"{c}.digest"), F.col(f"{c}.id").cast("string"))
        return F.sha2(F.concat_ws(":", *(F.coalesce(p, F.lit("")) for p in parts)), 256)

    kept = groups.where(F.col("row_key") == F.col("component_id")).select(code("row_key").alias("code")).distinct()
    joined = keyed.withColumn("code", code("row_key")).join(kept, "code", "left_semi")
    rest = [F.col(c) for n, c in names.items() if n not in ("doc_id", "text")]
    first = F.row_number().over(W.partitionBy("code").orderBy(*rest, key))
    one = joined.withColumn("nth", first).where("nth = 1")
    return one.select(*(F.col(c).alias(n) for n, c in names.items()))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row per document and pass with the words taken in it.

    Sources and weights are those of the mixing operator.  Documents without
    words, null texts among them, have nothing to give and are in no mix; a
    null source is a source; rows that repeat an id are documents of their own;
    equal runs take the same words.  An empty table gives an empty mix.
    """
    return mix_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text with an end id, and digests of the ids and of the text they decode to.

    A null or empty text is the end id alone; every row is encoded for itself,
    also with a null or repeated id.  An empty table gives no rows.
    """
    return encode_documents(docs, model_bytes(), outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: The stages of a trained model and of a tokenizer have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    folder = new_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
