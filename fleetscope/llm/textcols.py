"""Words of a text as Spark expressions; a word is a maximal run of `[^\\x20\\x09-\\x0D]`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words.
SPACES = " \t\n\x0b\x0c\r"


def trimmed(text: Column) -> Column:
    """The text without white space at its ends; null counts as empty."""
    return F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it, and however a filter or
    a projection above it is merged with it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_array(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return let(trimmed(text), lambda inner: F.when(inner == "", none).otherwise(F.split(inner, r"[\x20\x09-\x0D]+")))


def n_words(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")
