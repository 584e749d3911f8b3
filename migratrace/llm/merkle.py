"""Merkle manifest of a table: a tree per source, a tree over the sources, and a proof for every row.

Nodes of one tree are numbered in order; WIDTH ** DEPTH neighbours are a
superblock, which one task reduces to a node of the next round.  On the way
back the nodes that a superblock lacks, those above it, are cogrouped with its
own, so that reduction, proof and folding happen in one pass over the leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from migratrace.session import materialize, ship_package

WIDTH = 16
DEPTH = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The nodes above a superblock, level by level: digests left of the path, and right of it, as one text each.
_ABOVE = "lefts array<string>, rights array<string>, subroot string, root string"
_HOME = "home string, block long"


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    """The digest of a row, as lower-case hex."""
    return F.sha2(F.concat(*(field_text(c) for c in columns)), 256)


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (tree, ...) with idx, their place in their tree by ``order``; n, the tree's size; start, the rows of all trees before it.

    Rows are range-partitioned, so a tree of any size spreads over tasks.  What
    is joined back has one row per range and tree in it; only a row per range
    passes one window.
    """
    names = rows.columns
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)

    def number(batches: Iterator[pa.RecordBatch]):
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = [pa.array([task] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *places], names=[*names, "range_no", "place"])
            at += n

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = materialize(ranged.mapInArrow(number, f"{schema}, range_no int, place long"), "placed")
    runs = placed.groupBy("range_no", "tree").agg(F.min("place").alias("first_place"), F.count("*").alias("rows"))
    runs = materialize(runs, "runs")
    before = F.sum("rows").over(W.orderBy("range_no").rowsBetween(W.unboundedPreceding, -1))
    offsets = runs.groupBy("range_no").agg(F.sum("rows").alias("rows")).select("range_no", F.coalesce(before, F.lit(0)).alias("offset"))
    runs = runs.join(offsets, "range_no")
    trees = runs.groupBy("tree").agg(F.min(F.col("offset") + F.col("first_place")).alias("start"), F.sum("rows").alias("n"))
    known = materialize(runs.join(trees, "tree").select("range_no", "tree", "offset", "start", "n"), "ranges")
    joined = placed.join(known, ["range_no", "tree"])
    return joined.select(*names, (F.col("offset") + F.col("place") - F.col("start")).alias("idx"), "n", "start")


def _homed(nodes: DataFrame, size: int) -> DataFrame:
    """``nodes`` with the group (home, block) that handles them: a superblock, or neighbouring trees that fit in one."""
    small = F.col("n") <= size
    return nodes.withColumns(
        {
            "home": F.when(small, F.lit("")).otherwise(F.concat(F.lit("t"), F.col("tree"))),
            "block": F.expr(f"CASE WHEN n <= {size} THEN start div {size} ELSE idx div {size} END"),
        }
    )


def _rise(digests: list[str], whole: bool, width: int, depth: int) -> list[list[str]]:
    """The levels over a superblock's nodes: up to one node if it is the ``whole`` tree, else exactly ``depth``."""
    levels = [digests]
    while len(levels[-1]) > 1 if whole else len(levels) <= depth:
        last = levels[-1]
        levels.append([_hash("".join(last[i : i + width])) for i in range(0, len(last), width)])
    return levels


def _steps(levels: list[list[str]], i: int, width: int) -> tuple[list[str], list[str]]:
    """Digests left and right of the path of node ``i``, level by level."""
    lefts, rights = [], []
    for level in levels[:-1]:
        first = i - i % width
        lefts.append("".join(level[first:i]))
        rights.append("".join(level[i + 1 : first + width]))
        i //= width
    return lefts, rights


def _blocks(group: pd.DataFrame, size: int, width: int, depth: int):
    """The superblocks of a group: their rows in order, and the levels over them."""
    ordered = group.sort_values(["tree", "idx"], kind="stable")
    for tree, rows in ordered.groupby("tree", sort=False):
        yield tree, rows, _rise(rows["digest"].tolist(), int(rows["n"].iloc[0]) <= size, width, depth)


def _climb(nodes: DataFrame, width: int, depth: int) -> list[tuple[DataFrame, DataFrame]]:
    """Round by round the nodes and what their superblocks come to; a tree is done where its n is 1."""
    size = width**depth

    def tops(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, rows, levels in _blocks(group, size, width, depth):
            first = rows.iloc[0]
            out.append((first["home"], first["block"], tree, first["idx"] // size, -(-first["n"] // size), first["start"] // size, levels[-1][0]))
        return pd.DataFrame(out, columns=["from_home", "from_block", "tree", "idx", "n", "start", "digest"])

    rounds = []
    while True:
        nodes = _homed(nodes, size)
        schema = "from_home string, from_block long, tree string, idx long, n long, start long, digest string"
        made = nodes.select("home", "block", "tree", "idx", "n", "start", "digest").groupBy("home", "block").applyInPandas(tops, schema)
        made = materialize(made, "tops")
        rounds.append((nodes, made))
        if not made.where("n > 1").limit(1).count():
            return rounds
        nodes = made.where("n > 1")


def _ways(nodes: DataFrame, above: DataFrame, columns: str, picked: list[str], width: int, depth: int) -> DataFrame:
    """For every node the columns ``picked`` of it and all that lies above it."""
    size = width**depth

    def run(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        upper = {row.tree: row for row in outer.itertuples(index=False)}
        out = []
        for tree, rows, levels in _blocks(own, size, width, depth):
            top = upper[tree]
            shift = int(rows["idx"].iloc[0])
            for row, i in zip(rows[picked].itertuples(index=False), rows["idx"], strict=True):
                lefts, rights = _steps(levels, int(i) - shift, width)
                out.append((*row, [*lefts, *top.lefts], [*rights, *top.rights], top.subroot, top.root))
        return pd.DataFrame(out, columns=[*picked, "lefts", "rights", "subroot", "root"])

    return nodes.groupBy("home", "block").cogroup(above.groupBy("home", "block")).applyInPandas(run, f"{columns}, {_ABOVE}")


def _descend(rounds: list[tuple[DataFrame, DataFrame]], crowns: DataFrame, width: int, depth: int) -> DataFrame:
    """What lies above every superblock of the first round, given what lies above every tree (``crowns``)."""
    names = ["tree", "lefts", "rights", "subroot", "root"]
    above = None
    for turn in reversed(range(len(rounds))):
        tops = rounds[turn][1]
        ended = tops.where("n = 1").join(crowns, "tree").select(F.col("from_home").alias("home"), F.col("from_block").alias("block"), *names)
        if above is not None:
            columns = "from_home string, from_block long, tree string"
            nodes = rounds[turn + 1][0]
            went = _ways(nodes, above, columns, ["from_home", "from_block", "tree"], width, depth)
            ended = ended.unionByName(went.withColumnsRenamed({"from_home": "home", "from_block": "block"}))
        above = materialize(ended, "above")
    return above


def _crowns(rounds: list[tuple[DataFrame, DataFrame]], width: int, depth: int) -> DataFrame:
    """The tree over the subroots: (tree, lefts, rights, subroot, root) for every source's tree."""
    subroots = reduce(DataFrame.unionByName, [tops.where("n = 1").select("tree", "digest") for _, tops in rounds])
    leaves = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    over = _climb(materialize(_numbered(leaves, "source_tree"), "subroots"), width, depth)
    none = F.array().cast("array<string>")
    root = over[-1][1].select("tree", none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = _descend(over, root, width, depth)
    ways = _ways(over[0][0], above, "source_tree string, digest string", ["source_tree", "digest"], width, depth)
    return materialize(ways.select(F.col("source_tree").alias("tree"), "lefts", "rights", F.col("digest").alias("subroot"), "root"), "crowns")


def merkle_manifest(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    fields: tuple[str, ...] = FIELDS,
    presented: dict[str, Column] | None = None,
    width: int = WIDTH,
    depth: int = DEPTH,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    H is lower-case hex SHA-256 of its inputs one after the other, digests as
    hex.  A leaf is H of ``fields``, each ``-`` if null, else its UTF-8 length,
    a colon and the value.  The leaves of a source in order of ``key`` (null
    first, equal keys by leaf) are reduced ``width`` neighbours at a time, the
    last run as it is, until one is left: the subroot.  Subroots in order of
    the source (null first, else by UTF-8 bytes) are reduced likewise to the
    root.  ``proof_sha256`` is H of the siblings on the way from leaf to root,
    level by level, left to right; a row that is alone has none.
    ``folded_root`` is recomputed from the siblings and the leaf of the row as
    ``presented`` (columns by field that take the place of the stored ones).

    Texts are hashed where they are read and never shuffled.  A task holds a
    superblock of ``width ** depth`` leaves, or neighbouring small trees of up
    to two such blocks, whatever the size of a source.  Rows that repeat a key,
    or one another, are leaves of their own; an empty table gives no rows;
    other columns are not read.
    """
    ship_package(docs.sparkSession)
    stored = [docs[f] for f in fields]
    shown = [(presented or {}).get(f, docs[f]) for f in fields]
    kind = docs.schema[key].dataType
    leaf = leaf_hash(stored)
    leaves = docs.select(
        F.when(docs[source].isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), docs[source].cast("string"))).alias("tree"),
        docs[key].alias("key_in"),
        F.unhex(leaf).alias("leaf"),
        F.unhex(F.nullif(leaf_hash(shown), leaf)).alias("shown"),
    )
    numbered = _numbered(materialize(leaves, "leaves"), "key_in", "leaf").select(
        "tree", F.col("key_in").cast("string").alias("key_in"), "idx", "n", "start",
        F.lower(F.hex("leaf")).alias("digest"), F.lower(F.hex("shown")).alias("shown"),
    )
    rounds = _climb(materialize(numbered, "numbered"), width, depth)
    above = _descend(rounds, _crowns(rounds, width, depth), width, depth)
    size = width**depth

    def finish(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        upper = {row.tree: row for row in outer.itertuples(index=False)}
        out = []
        for tree, rows, levels in _blocks(own, size, width, depth):
            top = upper[tree]
            shift = int(rows["idx"].iloc[0])
            high = "".join(left + right for left, right in zip(top.lefts, top.rights, strict=True))
            for row in rows.itertuples(index=False):
                lefts, rights = _steps(levels, int(row.idx) - shift, width)
                proof = _hash("".join(left + right for left, right in zip(lefts, rights, strict=True)) + high)
                folded = row.digest if row.shown is None else row.shown
                for left, right in zip([*lefts, *top.lefts], [*rights, *top.rights], strict=True):
                    folded = _hash(left + folded + right)
                out.append((row.key_in, row.digest, top.subroot, top.root, proof, folded, folded == top.root))
        return pd.DataFrame(out, columns=["key_in", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = "key_in string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    nodes = rounds[0][0]
    done = nodes.groupBy("home", "block").cogroup(above.groupBy("home", "block")).applyInPandas(finish, schema)
    return done.select(F.col("key_in").cast(kind).alias(key), *(c.split()[0] for c in schema.split(", ")[1:]))


def lower_cased_text(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: int = 5) -> Column:
    """``text`` with A-Z in lower case where ``part`` divides the CRC-32 of the decimal key, else as it is."""
    picked = F.crc32(docs[key].cast("string").cast("binary")) % part == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(picked, F.translate(docs[text], upper, upper.lower())).otherwise(docs[text])
