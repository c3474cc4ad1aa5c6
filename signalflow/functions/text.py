"""Text cleaning and tokenising with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as Python's ``str.isspace`` sees it, as a character class. Spelt
# out because a Unicode-aware ``\s`` is much slower and leaves out the ASCII separators.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# Fixed values, in this order: web addresses, mentions, tags, all but letters and space. The
# last one tests one character by look-ahead, which Java runs several times faster than a
# negated class of the same members; the most frequent ones, all in the class too, are tested first.
CLEANING_PATTERNS = (
    rf"http[^{SPACE}]+",
    rf"@[^{SPACE}]+",
    rf"#[^{SPACE}]+",
    rf"(?s)(?![a-z ])(?![a-zA-ZÀ-ÿ{SPACE}]).",
)

# Words the word tokeniser splits in two.
SPLIT_WORDS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))
SPLIT_POINTS = "(?U)" + "|".join(rf"(?<=\b{left})(?={right}\b)" for left, right in SPLIT_WORDS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    out = _col(c)
    for pattern in CLEANING_PATTERNS:
        out = F.regexp_replace(out, pattern, "")
    return F.lower(out)


def raw_words(c, split_contractions: bool = True) -> Column:
    """Array of the words of a cleaned text; leading or trailing space leaves empty words.

    ``c`` should be a plain column, it is used several times.
    """
    text = _col(c)
    if split_contractions:
        # the split pattern looks around at every position: run it only where it can match
        possible = reduce(or_, [F.contains(text, F.lit(left + right)) for left, right in SPLIT_WORDS])
        text = F.when(possible, F.regexp_replace(text, SPLIT_POINTS, " ")).otherwise(text)
    # no space is a letter: the look-ahead only passes over most letters at once
    return F.split(text, f"(?![a-z])[{SPACE}]+")


def words(c, split_contractions: bool = True) -> Column:
    """Array of the words of a cleaned text (empty array for blank text)."""
    return F.filter(raw_words(c, split_contractions), lambda w: w != "")


def without_words(tokens, stop: Sequence[str]) -> Column:
    # isin over literals becomes a hash-set test, array_contains would scan the list
    return F.filter(_col(tokens), lambda w: ~w.isin(*stop)) if stop else _col(tokens)


def joined(c, sep: str = ",") -> Column:
    """Array to text; a missing or empty array gives the empty text."""
    return F.coalesce(F.array_join(_col(c), sep), F.lit(""))


def strip_nul(c) -> Column:
    return F.translate(_col(c), "\u0000", "")


def map_strings(c: Column, dtype: T.DataType, fn: Callable[[Column], Column]) -> Column:
    """Apply ``fn`` to every text inside nested structs and arrays, other values untouched."""
    if isinstance(dtype, T.StringType):
        return fn(c)
    if isinstance(dtype, T.ArrayType) and _has_string(dtype.elementType):
        return F.transform(c, lambda item: map_strings(item, dtype.elementType, fn))
    if isinstance(dtype, T.StructType) and _has_string(dtype):
        fields = [map_strings(c[f.name], f.dataType, fn).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def _has_string(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_string(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_string(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.StringType)


def lang_matches(langs, lang: str, match: str = "contains") -> Column:
    """Language test: ``contains`` keeps mixed-language posts, ``exact`` does not."""
    if match == "contains":
        return _col(langs).contains(lang)
    if match == "exact":
        return _col(langs) == F.lit(lang)
    raise ValueError(f"unknown language match {match!r}")


def stop_words(spark, language: str) -> list[str]:
    """Stop list that ships with Spark ML."""
    from pyspark.ml.feature import StopWordsRemover

    spark.sparkContext  # the list is read through the running JVM
    return StopWordsRemover.loadDefaultStopWords(language)
