"""Mixing sources to target weights: packed blocks, drawn slots, permuted indices, one join by index.

Only DataFrame operations.  The words of a source form one stream, cut into
blocks of BLOCK words.  Output shards draw how many of their slots each source
fills; the slots of a source, numbered through all shards, run through a
pseudorandom permutation of its block numbers, pass after pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from migratrace.llm.common import WORD
from migratrace.session import materialize

WEIGHTS = (5, 2, 1)
#: Share of all words that the mix has, and the most a source may be repeated.
TOTAL = 1.5
REPEATS = 2
BLOCK = 64
#: Slots of an output shard.
SHARD = 4096
#: Documents whose offsets one window adds up, about.
CHUNK_ROWS = 1000
_CELLS = 1024
#: Rows that one window of a running sum holds; slots that one task makes, at most about.
SPAN = 1024
TASK_SLOTS = 1 << 22
_PRIMES = (1_000_003, 1_000_033, 1_000_037, 1_000_039, 1_000_081, 1_000_099, 1_000_117)
_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, *, weights=WEIGHTS, total: float = TOTAL, repeats: int = REPEATS) -> DataFrame:
    """Per source of ``sized`` (source, size): sid, source, source_size, weight, target.

    Sources in code point order, null last, take the weights in turn and share
    ``total`` times all sizes by weight.  No target is above ``repeats`` times
    its source; what is too much goes to the others by weight, until none is
    above.  With caps c and weights w that is min(c, x w), and x is the largest
    of the shares per weight left after capping the sources of smallest c / w.
    One row per source is all that a window sees.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    everyone = W.partitionBy(F.lit(0))
    number = F.row_number().over(everyone.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    caps = sums.withColumn("sid", number).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(repeats))
    before = everyone.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    left = F.sum("weight").over(everyone) - used
    level = (F.sum("source_size").over(everyone) * float(total) - filled) / left
    shared = caps.withColumn("level", level).withColumn("top", F.max("level").over(everyone))
    target = F.least("cap", F.col("top") * F.col("weight"))
    return shared.select("sid", "source", "source_size", "n_docs", "weight", target.cast("double").alias("target"))


def _running(frame: DataFrame, order: str, value: str) -> DataFrame:
    """``before``: the sum of ``value`` over the rows of the same ``sid`` with a smaller ``order``.

    ``order`` is a whole number that comes once per sid.  Sums are added up in
    spans of SPAN numbers and over the spans, so that no window holds a large
    source's rows.
    """
    spans = frame.withColumn("span", F.expr(f"{order} div {SPAN}"))
    inside = W.partitionBy("sid", "span").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("sid").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    sums = spans.groupBy("sid", "span").agg(F.sum(value).alias("all"))
    first = sums.select("sid", "span", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("first"))
    local = spans.withColumn("local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(first, ["sid", "span"]).withColumn("before", F.col("first") + F.col("local")).drop("span", "first", "local")


def _permuted(slots: DataFrame, seed: int) -> DataFrame:
    """``block``: slot number ``place`` of 0..n-1 under a permutation of these numbers that ``sid`` and ``seed`` set.

    Two maps x -> p x + q modulo n around four rounds of a Feistel network on
    the largest square below n; what lies beyond the square stays where it is.
    Each step is a bijection, so every block comes once per pass.
    """

    def linear(frame: DataFrame, step: int) -> DataFrame:
        p = F.lit(1)
        for prime in _PRIMES:
            p = F.when(F.col("n") % prime != 0, F.lit(prime)).otherwise(p)
        q = F.pmod(F.xxhash64(F.lit(seed), F.lit(step), "sid", "pass"), F.col("n"))
        return frame.withColumn("block", F.pmod(F.col("block") * p + q, F.col("n")))

    frame = linear(slots.withColumn("block", F.col("place")), 1)
    frame = frame.withColumn("side", F.floor(F.sqrt("n")).cast("long"))
    frame = frame.withColumn("inside", F.col("block") < F.col("side") * F.col("side"))
    frame = frame.withColumn("left", F.expr("block div side")).withColumn("right", F.expr("block % side"))
    for turn in range(4):
        one, two = ("left", "right") if turn % 2 == 0 else ("right", "left")
        noise = F.pmod(F.xxhash64(F.lit(seed), F.lit(turn + 10), "sid", "pass", two), F.col("side"))
        frame = frame.withColumn(one, F.pmod(F.col(one) + noise, F.col("side")))
    inner = F.col("left") * F.col("side") + F.col("right")
    frame = frame.withColumn("block", F.when(F.col("inside"), inner).otherwise(F.col("block")))
    return linear(frame, 2).drop("side", "inside", "left", "right")


def drawn_slots(sources: DataFrame, *, block: int = BLOCK, shard: int = SHARD, repeats: int = REPEATS, seed: int = 1) -> DataFrame:
    """(shard, sid, slot, pass, block, words): every slot of the mix with the block that fills it.

    Each shard draws its slots' sources independently by the targets, a
    multinomial count per source.  Draws beyond a source's number of slots are
    not used, and missing ones form a last shard, so that each source gets as
    many slots as its target needs, whatever was drawn, and at most ``repeats``
    passes.  ``words`` is how many of the block's first words the slot takes:
    all, but for the last three slots of a source, which take what its target lacks.
    """
    spark = sources.sparkSession
    n = F.ceil(F.col("source_size") / block).cast("long")
    enough = F.ceil(F.try_divide(F.col("target") * n, F.col("source_size").cast("double"))).cast("long") + 1
    full = F.least(n * repeats, enough)
    wanted = sources.select("sid", n.alias("n"), full.alias("wanted"), "target").where("wanted > 0 AND target > 0")
    below = W.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(W.unboundedPreceding, -1)
    cdf = wanted.select("sid", "n", "wanted", F.coalesce(F.sum("wanted").over(below), F.lit(0)).alias("low"))
    cdf = materialize(cdf.withColumn("high", F.col("low") + F.col("wanted")), "draw-bounds")
    total = cdf.agg(F.max("high")).first()[0] or 0
    shards = -(-total // shard)
    # a uniform number of 0..total-1 per slot; bounds are met through cells, of which many make up a large source
    cell = max(1, -(-total // _CELLS))
    point = F.pmod(F.xxhash64(F.lit(seed), F.lit(3), "id"), F.lit(max(total, 1)))
    slots = spark.range(0, total).select(F.expr(f"id div {shard}").alias("shard"), point.alias("point"))
    slots = slots.withColumn("cell", F.expr(f"point div {cell}"))
    cells = cdf.select("sid", "low", "high", F.explode(F.expr(f"sequence(low div {cell}, (high - 1) div {cell})")).alias("cell"))
    cells = materialize(cells, "draw-cells")
    drawn = slots.join(cells, "cell").where("point >= low AND point < high").groupBy("sid", "shard").agg(F.count("*").alias("count"))
    drawn = materialize(drawn, "draws")
    placed = _running(drawn, "shard", "count").withColumnRenamed("before", "start")
    got = drawn.groupBy("sid").agg(F.sum("count").alias("start"))
    last = cdf.select("sid").join(got, "sid", "left").select("sid", F.lit(shards).alias("shard"), F.coalesce("start", F.lit(0)).alias("start"))
    ranges = placed.select("sid", "shard", "start", (F.col("start") + F.col("count")).alias("stop")).unionByName(
        last.withColumn("stop", F.lit((1 << 62)))
    )
    used = ranges.join(cdf.select("sid", "n", "wanted"), "sid").withColumn("stop", F.least("stop", "wanted")).where("start < stop")
    # long ranges are cut, so that one row makes at most a shard's slots
    used = used.withColumn("part", F.explode(F.expr(f"sequence(0L, (stop - start - 1) div {shard})")))
    used = used.select(
        "sid", "shard", "n", (F.col("start") + F.col("part") * shard).alias("start"),
        F.least(F.col("start") + (F.col("part") + 1) * shard, "stop").alias("stop"),
    )
    # the ranges are few rows, which would end up in few tasks; their slots are many
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_SLOTS))
    used = used.repartition(tasks, "sid", "start")
    slots = used.select("sid", "shard", "n", F.explode(F.expr("sequence(start, stop - 1)")).alias("slot"))
    slots = slots.withColumn("pass", F.expr("slot div n")).withColumn("place", F.expr("slot % n"))
    slots = materialize(_permuted(slots, seed).select("shard", "sid", "slot", "pass", "block"), "slots")
    ends = sources.select("sid", n.alias("n"), full.alias("wanted"), "source_size", "target")
    slots = slots.join(ends, "sid").withColumn(
        "words", F.when(F.col("block") == F.col("n") - 1, F.col("source_size") - (F.col("n") - 1) * block).otherwise(F.lit(block).cast("long"))
    )
    # the last three slots of a source make up for its short block: they take what the others leave of the target
    tail = F.col("slot") >= F.col("wanted") - 3
    others = materialize(slots.where(~tail).groupBy("sid").agg(F.sum("words").alias("others")), "slot-words")
    before = F.coalesce(F.sum("words").over(W.partitionBy("sid").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.round("target").cast("long") - F.coalesce("others", F.lit(0)) - before
    last = slots.where(tail).join(others, "sid", "left").withColumn("rest", rest)
    last = last.withColumn("words", F.greatest(F.lit(0).cast("long"), F.least("words", "rest")))
    columns = ["shard", "sid", "slot", "pass", "block", "words"]
    return slots.where(~tail).select(*columns).unionByName(last.select(*columns))


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Row identity, source and number of words; equal rows are told apart by ``nth``."""
    picked = docs.select(
        docs[key].alias("id"),
        docs[source].alias("source"),
        F.xxhash64(docs[text], docs[text].isNull()).alias("print"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    nth = F.row_number().over(W.partitionBy("id", "source", "print").orderBy("size"))
    return picked.withColumn("nth", nth)


class Mix:
    """The parts of a mix: ``sources``, ``placed`` documents, ``pieces`` of them by block, and ``slots``."""

    def __init__(self, docs: DataFrame, *, key="doc_id", text="text", source="source", block=BLOCK, shard=SHARD, repeats=REPEATS, weights=WEIGHTS, total=TOTAL, seed=1):
        sized = materialize(_sized(docs, key, text, source), "sizes")
        self.sources = materialize(
            source_targets(sized, weights=weights, total=total, repeats=repeats), "sources"
        )
        number = sized.join(
            self.sources.select("sid", F.col("source").alias("name"), "n_docs"), F.col("source").eqNullSafe(F.col("name"))
        ).drop("name")
        chunks = F.ceil(F.col("n_docs") / CHUNK_ROWS).cast("long")
        chunked = number.withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed), "id", "print", "nth"), chunks)).drop("n_docs")
        inside = W.partitionBy("sid", "chunk").orderBy("id", "print", "nth").rowsBetween(W.unboundedPreceding, -1)
        local = materialize(chunked.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0))), "offsets")
        sums = local.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
        first = materialize(_running(sums, "chunk", "words").select("sid", "chunk", F.col("before").alias("first")), "chunks")
        self.placed = local.join(first, ["sid", "chunk"]).select(
            "id", "source", "print", "nth", "sid", "size", (F.col("first") + F.col("local")).alias("start")
        )
        inner = F.col("block") * block
        self.pieces = (
            self.placed.where("size > 0")
            .withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
            .select(
                "sid", "start", "block",
                (F.greatest(inner, "start") - F.col("start")).alias("at"),
                (F.greatest(inner, "start") - inner).alias("inner"),
                (F.least(inner + block, F.col("start") + F.col("size")) - F.greatest(inner, "start")).alias("words"),
            )
        )
        self.slots = drawn_slots(self.sources, block=block, shard=shard, repeats=repeats, seed=seed)

    def taken_pieces(self) -> DataFrame:
        """(sid, start, at, takes): pieces of documents and how many of their words each slot takes, most first."""
        slots = self.slots.groupBy("sid", "block").agg(F.sort_array(F.collect_list("words"), asc=False).alias("limits"))
        takes = F.transform("limits", lambda n: F.greatest(F.lit(0).cast("long"), F.least(n - F.col("inner"), F.col("words"))))
        return self.pieces.join(slots, ["sid", "block"]).select("sid", "start", "at", takes.alias("takes"))


def mix_report(docs: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: key, size, source_size, target and taken.

    size is the number of words of the whole text (null: 0), target the number
    of words its source is to give, taken how many of the document's words the
    mix has, repeats counted.  Words are runs of other characters than ASCII
    white space.  Each source gives its target, rounded, no document is taken more than REPEATS times, and reruns agree.  Null keys and
    sources are values like others; repeated rows are documents of their own;
    an empty table gives no rows; other columns are not read.
    """
    mix = Mix(docs, key=key, **options)
    taken = mix.taken_pieces().groupBy("sid", "start").agg(
        F.sum(F.aggregate("takes", F.lit(0).cast("long"), lambda a, n: a + n)).alias("taken")
    )
    placed = mix.placed.join(mix.sources.select("sid", "source_size", "target"), "sid")
    # a document without words has no place in the stream of its own
    full = placed.where("size > 0").join(taken, ["sid", "start"], "left")
    rows = full.unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return rows.select(F.col("id").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", length: str | None = "n_chars", **options
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per document and pass, its text the words taken in it.

    A document whose words are all taken keeps its text as it is; else each
    taken word comes with the white space before it.  Documents of which
    nothing is taken do not appear.  ``length`` names a column that is set to
    the number of characters, if there is one.
    """
    mix = Mix(docs, key=key, text=text, source=source, **options)
    item = F.struct("at", "takes")
    lists = mix.taken_pieces().groupBy("sid", "start").agg(F.sort_array(F.collect_list(item)).alias("pieces"))
    found = mix.placed.where("size > 0").join(lists, ["sid", "start"]).select("id", "source", "print", "nth", "size", "pieces")
    found = materialize(found, "pieces").toDF("m_id", "m_source", "m_print", "m_nth", "m_size", "m_pieces")
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    own = {n: f"c{i}" for i, n in enumerate(names)}
    id_, text_, source_ = own[key], own[text], own[source]
    marked = plain.withColumn("r_print", F.xxhash64(text_, F.col(text_).isNull()))
    marked = marked.withColumn("r_nth", F.row_number().over(W.partitionBy(id_, source_, "r_print").orderBy(F.lit(0))))
    same = (
        F.col(id_).eqNullSafe(F.col("m_id")) & F.col(source_).eqNullSafe(F.col("m_source"))
        & (F.col("r_print") == F.col("m_print")) & (F.col("r_nth") == F.col("m_nth"))
    )
    joined = marked.join(found, same)
    most = F.array_max(F.transform("m_pieces", lambda p: F.size(F.filter(p["takes"], lambda n: n > 0))))
    passes = joined.withColumn("m_most", most).where("m_most > 0").withColumn("m_pass", F.explode(F.expr("sequence(1, m_most)")))
    now = F.transform("m_pieces", lambda p: F.struct(p["at"].alias("at"), F.coalesce(F.get(p["takes"], F.col("m_pass") - 1), F.lit(0)).alias("words")))
    passes = passes.withColumn("m_taken", F.filter(now, lambda p: p["words"] > 0))
    taken = F.col("m_taken")
    words = F.aggregate(taken, F.lit(0).cast("long"), lambda a, p: a + p["words"])
    tokens = F.regexp_extract_all(text_, F.lit(_TOKEN), F.lit(0))
    passes = passes.withColumn("m_tokens", F.when(words < F.col("m_size"), tokens))
    cut = F.array_join(
        F.flatten(F.transform(taken, lambda p: F.slice("m_tokens", (p["at"] + 1).cast("int"), p["words"].cast("int")))), ""
    )
    result = passes.withColumn(text_, F.when(words < F.col("m_size"), cut).otherwise(F.col(text_)))
    if length in own:
        kind = docs.schema[length].dataType
        result = result.withColumn(own[length], F.length(text_).cast(kind))
    return result.select(*(F.col(own[n]).alias(n) for n in names))
