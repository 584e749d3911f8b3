"""Text cleaning and tokens as column expressions.

Character classes are spelled out with Unicode properties, so accented text and
non-breaking spaces are treated alike whatever the regex dialect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from migratrace.functions.columns import text_or_empty
from migratrace.operators.rules import sql_text

# ---- fixed values: patterns ------------------------------------------------
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
TAG = "<[^>]+>"
LINK = f"http{NOT_SPACE}+"
PLACEHOLDER = r"\[(?:URL|IP|PHONE|TICKET)\]"
DOTTED_QUAD = r"\p{Nd}{1,3}\.\p{Nd}{1,3}\.\p{Nd}{1,3}\.\p{Nd}{1,3}"
ERROR_CODE = r"err[_-]?\p{Nd}{2,6}|exception|traceback|error code \p{Nd}+"
ALPHA_TOKEN = r"(?<![\p{L}\p{N}_])\p{L}++(?![\p{L}\p{N}_])"
TERM_TOKEN = r"[\p{L}\p{N}_]{2,}"

# ---- fixed values: the English stop words of Spark ML, without apostrophes --
STOP_WORDS = tuple(
    """
    a about above after again against all am an and any are as at be because been before being below between
    both but by can cannot could did do does doing don down during each few for from further had has have having
    he her here hers herself him himself his how i if in into is it its itself just me more most my myself no nor
    not now of off on once only or other ought our ours ourselves out over own s same she should so some such t
    than that the their theirs them themselves then there these they this those through to too under until up
    very was we were what when where which while who whom why will with would you your yours yourself yourselves
    """.split()
)
# ---- end of fixed values ---------------------------------------------------


def full_text(*parts: Column) -> Column:
    """The parts with single spaces between them; a missing part is empty."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [text_or_empty(part)] if not pieces else [F.lit(" "), text_or_empty(part)]
    return F.concat(*pieces)


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def clean_text(c: Column) -> Column:
    """Lowercase text without tags, links, placeholders and dotted quads."""
    out = text_or_empty(c)
    for pattern in (TAG, LINK, PLACEHOLDER, DOTTED_QUAD):
        out = F.regexp_replace(out, pattern, " ")
    return squeeze(F.lower(out))


def error_codes(c: Column) -> Column:
    """The distinct error signs in the text, sorted and joined by spaces."""
    found = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(ERROR_CODE), F.lit(0))
    return F.array_join(F.array_sort(F.array_distinct(found)), " ")


def _without(tokens: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda x: ~x.isin(list(stop_words)))


def alpha_tokens(c: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Purely alphabetic words that are no stop words, in order."""
    return _without(F.regexp_extract_all(text_or_empty(c), F.lit(ALPHA_TOKEN), F.lit(0)), stop_words)


def words(c: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lowercase words of two or more characters that are no stop words, in order."""
    return _without(F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(TERM_TOKEN), F.lit(0)), stop_words)


def stop_list_sql(stop_words: Sequence[str] = STOP_WORDS) -> str:
    return ", ".join(sql_text(w) for w in stop_words)
