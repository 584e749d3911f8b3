"""Quality rules as a cascade: what rejects most for its cost comes first, and decides alone."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace.llm.common import slices
from migratrace.llm.textscan import buffers, per_row, windows, word_bounds, word_hashes
from migratrace.session import ship_package

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SYMBOLS = b"#*$%&|<>"
BLANK_TEXT = " \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Rows that the order of the rules is estimated on, about; results do not depend on the order.
SAMPLE_ROWS = 2000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


class Base(NamedTuple):
    """The base figures of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


class Rule(NamedTuple):
    name: str
    rejects: Callable[[str, Base], bool]


def _symbols(text: str, base: Base) -> bool:
    return 10 * base.n_symbols > base.n_words


def _word_length(text: str, base: Base) -> bool:
    return not 2 * base.n_words <= base.word_chars <= 12 * base.n_words


def _dup_lines(text: str, base: Base) -> bool:
    return base.n_dup_lines > 0 and 100 * base.n_dup_lines > 40 * sum(1 for x in text.split("\n") if x.strip(BLANK_TEXT))


def _shouting(text: str, base: Base) -> bool:
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    return 100 * upper > 30 * (upper + lower)


def _letters(text: str, base: Base) -> bool:
    return 100 * sum(map(str.isalpha, text)) < 50 * base.word_chars


def _words(text: str) -> list[str]:
    return [w for w in text.translate(_TO_SPACE).split(" ") if w]


_TO_SPACE = str.maketrans(dict.fromkeys(BLANK_TEXT, " "))


def _distinct(text: str, base: Base) -> bool:
    return 100 * len(set(_words(text))) < 20 * base.n_words


def _top_word(text: str, base: Base) -> bool:
    return 100 * max(Counter(_words(text)).values()) > 30 * base.n_words


#: Rules on top of the base; a text that one of them rejects is not kept.
RULES = (
    Rule("symbols", _symbols),
    Rule("word_length", _word_length),
    Rule("dup_lines", _dup_lines),
    Rule("shouting", _shouting),
    Rule("letters", _letters),
    Rule("distinct_words", _distinct),
    Rule("top_word", _top_word),
)


def _base(column: pa.Array) -> np.ndarray:
    """The base figures of every text, a row each."""
    data, rows = buffers(column)
    starts, ends, words = word_bounds(data, rows)
    solid = np.zeros(len(data) + 1, np.int8)
    np.add.at(solid, starts, 1)
    np.add.at(solid, ends, -1)
    inside = np.cumsum(solid[:-1], dtype=np.int8) > 0
    hashes = word_hashes(data, starts, ends)
    at, found = windows(hashes, words, WINDOW)
    repeated = np.zeros(len(starts), bool)
    if len(at):
        row = np.searchsorted(words, at, "right") - 1
        order = np.lexsort((found, row))
        same = (found[order][1:] == found[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(starts) + 1, np.int64)
        np.add.at(step, at[twice], 1)
        np.add.at(step, at[twice] + WINDOW, -1)
        repeated = np.cumsum(step[:-1]) > 0
    lines = []
    for text in column.to_pylist():
        full = [x for x in (text or "").split("\n") if x.strip(BLANK_TEXT)]
        lines.append(len(full) - len(set(full)))
    return np.stack(
        [
            words[1:] - words[:-1],
            per_row(inside & ((data & 0xC0) != 0x80), rows),
            per_row(_SYMBOL[data], rows),
            np.array(lines, np.int64),
            per_row(repeated, words),
        ],
        axis=1,
    )


def _base_failed(base: Base) -> bool:
    return base.n_words < MIN_WORDS or 100 * base.n_repeat_words > MAX_REPEAT_PERCENT * base.n_words


def rule_order(docs: DataFrame, rules=RULES, *, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejections per second, as measured on a sample of about ``rows`` rows.

    The expected cost of a cascade is least in this order if the rules reject
    independently.  A rule that rejects nothing in the sample comes last,
    cheaper ones first; ties keep the given order.
    """
    ship_package(docs.sparkSession)
    total = docs.count()
    if not total:
        return [r.name for r in rules]

    def run(batches):
        for part in slices(batches, "text_in"):
            column = part.column("text_in")
            bases = [Base(*map(int, b)) for b in _base(column)]
            texts = [(t or "", b) for t, b in zip(column.to_pylist(), bases, strict=True) if not _base_failed(b)]
            for rule in rules:
                start = time.perf_counter()
                hits = sum(rule.rejects(t, b) for t, b in texts)
                yield pa.RecordBatch.from_pydict(
                    {"rule": [rule.name], "hits": [hits], "seconds": [time.perf_counter() - start]}
                )

    sample = docs.select(docs[text].alias("text_in")).sample(min(1.0, rows / total), seed=7)
    figures = sample.mapInArrow(run, "rule string, hits long, seconds double").groupBy("rule")
    found = {r["rule"]: r for r in figures.agg(F.sum("hits").alias("hits"), F.sum("seconds").alias("seconds")).collect()}
    if not found:
        return [r.name for r in rules]
    rate = {n: (-(r["hits"] / max(r["seconds"], 1e-9)), r["seconds"]) for n, r in found.items()}
    return sorted((r.name for r in rules), key=lambda n: rate[n])


def quality_cascade(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", rules=RULES, order: list[str] | None = None
) -> DataFrame:
    """Base figures and verdict of every whole text of ``docs``.

    Returns ``key``, the columns of ``BASE``, base_failed, kept, and rejected_by
    (``base`` or the rule that decided; null if kept).  The rules run in
    ``order`` (by default that of ``rule_order``), each only on texts that none
    has rejected before; ``kept`` is the same in any order, ``rejected_by`` is
    the first rule in it.

    A null text has no words and fails the base.  Null and repeated keys are
    kept, a row each; an empty table gives no rows; other columns are not read.
    Nothing is shuffled; a task holds one slice of texts at a time.
    """
    ship_package(docs.sparkSession)
    if order is None:
        order = rule_order(docs, rules, text=text)
    ordered = [r for n in order for r in rules if r.name == n]
    kind = docs.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in BASE.split(", ")]

    def run(batches):
        for part in slices(batches, "text_in"):
            column = part.column("text_in")
            figures = _base(column)
            bases = [Base(*b) for b in figures.tolist()]
            failed = [_base_failed(b) for b in bases]
            by = ["base" if f else None for f in failed]
            alive = [i for i, f in enumerate(failed) if not f]
            texts = column.to_pylist()
            for rule in ordered:
                left = []
                for i in alive:
                    if rule.rejects(texts[i], bases[i]):
                        by[i] = rule.name
                    else:
                        left.append(i)
                alive = left
            arrays = [part.column("key_in"), *(pa.array(figures[:, k]) for k in range(len(names)))]
            arrays += [pa.array(failed, pa.bool_()), pa.array([b is None for b in by], pa.bool_()), pa.array(by, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key_in", *names, "base_failed", "kept", "rejected_by"])

    picked = docs.select(docs[key].alias("key_in"), docs[text].alias("text_in"))
    out = f"key_in {kind}, {BASE}, base_failed boolean, kept boolean, rejected_by string"
    return picked.mapInArrow(run, out).withColumnRenamed("key_in", key)
