"""Column expressions that the native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that separates words.
SPACE = " \t\n\u000b\f\r"
_SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; none if it is null or has only white space."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPACE_RUN))


def is_blank(text: Column) -> Column:
    return F.trim(text, F.lit(SPACE)) == ""


def count_without(text: Column, characters: str) -> Column:
    """Code points of a text that are none of the characters."""
    return F.char_length(F.translate(text, characters, ""))
