"""What the operators of this subpackage share: session set-up, slices of batches, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from migratrace.session import materialize, own_folder, ship_package

#: ASCII white space, as the word patterns of the contracts name it.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task takes up at a time; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    ship_package(spark)
    return f"{own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text of a slice stays near ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, label), label the smallest node reached.

    Every round replaces the edges of a node by edges to the smallest of its
    neighbours, first among all of them, then among the smaller ones; it ends
    when all edges point to roots.  The number of rounds grows with the
    logarithm of the longest path.  Each round is written to the shared folder
    and only keyed aggregations and joins run, which split hot nodes.
    """
    links = materialize(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), "links"
    )
    while True:
        # all neighbours of a node hang on the smallest of them (or itself)
        both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = materialize(large, "large")
        # a node's smaller neighbours hang on the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(least, "v")
            .select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
            .select("e.v", "e.u")
            .where("u < v")
            .distinct()
        )
        small = materialize(small, "small")
        state = small.agg(F.count("*").alias("n"), F.countDistinct("v").alias("d")).first()
        roots = small.join(small.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        links = small
        if state["n"] == state["d"] and not roots:
            break
    return links.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(
        links.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
    )
