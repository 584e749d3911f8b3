"""Token counts through a cache keyed by digests of content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migratrace.llm.common import slices
from migratrace.llm.pieces import codec_of
from migratrace.session import materialize, ship_package

CACHE = "content binary, tokenizer string, n_tokens long"


def _empty_for_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tokenizer_version(library: str, file: bytes) -> str:
    """Digest of the library's kind and version and of the vocabulary file."""
    from importlib.metadata import version

    return hashlib.sha256(f"{library} {version(library)}\n".encode() + file).hexdigest()


def _counter(library: str, file: bytes) -> Callable[[list[str]], list[int]]:
    if library == "sentencepiece":
        return codec_of(file).count_all
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = _empty_for_null,
) -> DataFrame:
    """Rows (key, n_bytes, n_tokens) for every row of ``docs``; new counts go to ``cache``.

    ``cache`` is a Parquet folder (content, tokenizer, n_tokens) in storage that
    all executors share.  A text is looked up by the SHA-256 of its normalised
    form and the tokenizer's version; texts that are not there are encoded once
    per distinct digest and appended, so a second call encodes nothing.
    ``normalise`` may only join texts that have equal counts; the default makes
    null the empty text (0 tokens).  ``.model`` files are read by sentencepiece,
    all others by tokenizers; no begin, end or special ids are added.

    Copies are reduced before the shuffle, so a text that a third of the rows
    share is moved once per task.  Null and repeated keys are kept, a row each;
    an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    library = "sentencepiece" if tokenizer_path.endswith(".model") else "tokenizers"
    with open(tokenizer_path, "rb") as f:
        file = f.read()
    version = tokenizer_version(library, file)
    normal = normalise(docs[text])
    keyed = docs.select(
        docs[key].alias("key_in"),
        F.octet_length(_empty_for_null(docs[text])).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(normal, 256)).alias("content"),
    )
    contents = docs.select(F.unhex(F.sha2(normal, 256)).alias("content"), normal.alias("text_in")).dropDuplicates(["content"])

    def run(batches):
        count = _counter(library, file)
        for part in slices(batches, "text_in"):
            numbers = pa.array(count(part.column("text_in").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("content"), numbers], names=["content", "n_tokens"])

    stored = _stored(spark, cache, version)
    missing = contents.join(stored.select("content"), "content", "left_anti")
    counted = missing.mapInArrow(run, "content binary, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    # a plain table, so that the join can split a digest that many rows share
    counts = materialize(_stored(spark, cache, version), "counts")
    return keyed.join(counts, "content").select(F.col("key_in").alias(key), "n_bytes", "n_tokens")


def _stored(spark, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer; runs that were appended at the same time may hold a digest twice."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "content binary, n_tokens long")
    frame = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    return frame.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))
