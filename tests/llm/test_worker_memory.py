"""What a task of the language and piece steps holds at a time: batches bounded in bytes, a bounded memo."""

import pyarrow as pa
from pyspark.sql import functions as F

from migratrace.llm.lang_id import fit_language_model, identify
from migratrace.llm.pieces import PieceCodec, encode_documents
from migratrace.llm.queries import model_bytes
from migratrace.session import BATCH_BYTES

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def _sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.get_total_buffer_size()])], names=["rows", "bytes"])


def test_batches_are_bounded_in_bytes_unless_the_session_has_a_bound(spark):
    ids = spark.range(0, 3000, 1, 1).withColumnRenamed("id", "doc_id")
    docs = ids.select("doc_id", F.repeat(F.lit("one line of it "), 700).alias("text"), F.lit("en").alias("lang"))
    few = docs.limit(3)
    steps = (lambda: fit_language_model(few), lambda: identify(few, None), lambda: encode_documents(few, model_bytes()))
    try:
        for step in steps:
            spark.conf.unset(BOUND)
            step()
            seen = docs.mapInArrow(_sizes, "rows long, bytes long").collect()
            assert sum(r["rows"] for r in seen) == 3000
            assert max(r["bytes"] for r in seen) < 2 * BATCH_BYTES
            spark.conf.set(BOUND, "1000000")
            step()
            assert spark.conf.get(BOUND) == "1000000"
    finally:
        spark.conf.unset(BOUND)


def test_memo_of_words_is_bounded_and_changes_no_ids():
    codec = PieceCodec(model_bytes())
    for start in range(0, 130_000, 5_000):
        text = " ".join(f"w{i}" for i in range(start, start + 5_000))
        assert codec.encode(text) == codec.library.encode(text)
        assert len(codec.memo) < 60_000
