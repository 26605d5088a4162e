"""Text rendering and clean-up before embedding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept for the encoder, whitespace characters, and the wording of
# the first rendering.
ENCODER_MAX_CHARS = 512
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PHRASE_WORDS = ("taxi ride manhattan", "to", "distance", "miles fare", "dollars")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind; only the ends are looked at."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(F.length(strip(c)) == 0, F.lit(True))


def truncate(c: Column | str, max_chars: int = ENCODER_MAX_CHARS) -> Column:
    return F.substring(_col(c), 1, max_chars)


def trip_phrase(
    origin: str,
    destination: str,
    distance: str,
    fare: str,
    words: Sequence[str] = PHRASE_WORDS,
) -> Column:
    """Words and values joined by spaces; a null value leaves no gap."""
    start, to, dist_word, fare_word, end = words
    return F.concat_ws(
        " ",
        F.lit(start),
        F.col(origin).cast("string"),
        F.lit(to),
        F.col(destination).cast("string"),
        F.lit(dist_word),
        F.col(distance).cast("string"),
        F.lit(fare_word),
        F.col(fare).cast("string"),
        F.lit(end),
    )


def _number_or(name: str | None, default: int, type_name: str) -> Column:
    value = F.lit(default) if name is None else F.coalesce(F.col(name), F.lit(default))
    return value.cast(type_name)


def trip_sentence(
    origin: str | None,
    destination: str | None,
    distance: str | None,
    fare: str | None,
    passengers: str | None,
    subject: str = "Yellow taxi trip",
) -> Column:
    """A readable sentence; an absent column (None) or null value takes its default."""
    riders = _number_or(passengers, 1, "bigint")
    return F.concat(
        F.lit(f"{subject} from zone "),
        _number_or(origin, 0, "bigint").cast("string"),
        F.lit(" to zone "),
        _number_or(destination, 0, "bigint").cast("string"),
        F.lit(", "),
        _number_or(distance, 0, "decimal(18,1)").cast("string"),
        F.lit(" miles, $"),
        _number_or(fare, 0, "decimal(18,2)").cast("string"),
        F.lit(" fare, "),
        riders.cast("string"),
        F.when(riders > 1, F.lit(" passengers")).otherwise(F.lit(" passenger")),
    )
