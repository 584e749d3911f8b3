"""A small table with every odd case, and plain versions of words and shingles."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
#: Null and repeated keys, null, empty, blank and very long texts, ties; then columns with names that operators use.
ODD = [
    (None, "le chat est ici", "fr", None, 15),
    (None, None, None, None, None),
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \t\n ", "en", "b", 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, "The cat sat on the mat\nThe cat sat on the mat\nend.", "en", "c", 50),
    (5, "The cat sat on the mat\nThe cat sat on the mat\nend.", "en", "c", 50),
    (6, "THE CAT sat on the mat\nthe cat sat on the mat\nend.", "en", None, 50),
    (7, "1234 !!! ▁ <s> \x00 \U0001f600 é", "de", "c", 20),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["id", "key_in", "text_in", "n", "node", "score", "kept", "keep_map", "ids", "payload", "sid", "rejected", "m_pass", "c0"]


def odd_table(spark, clashes: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES}) if clashes else df


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def ascii_lower(text: str) -> str:
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def shingles(text: str | None) -> frozenset:
    w = words(ascii_lower(text or ""))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
