"""Removal of globally repeated runs of lines, in DataFrame functions only.

The lines of a document are grouped into chunks whose borders follow from the lines themselves:
a rolling hash over a line and the one before it makes the place after it a candidate, and a
candidate is a border unless the place before is one too.  So an inserted line moves no border but
those next to it, and every chunk but a document's last has two lines at least.  What a border
cuts, or what is shorter than a chunk, is caught by pairs: each line that isn't blank together
with the next such line.  A line of ``passage_words`` words or more is a chunk of its own besides.

A chunk or pair of ``min_words`` words in two lines that aren't blank, or of ``passage_words``
words, that occurs again anywhere is removed, except where it occurs first (by document id and
place).  The text of every removed line stays at its first place.

* Documents are reduced to two 64-bit hashes and a number of words a line.  These, without any
  text, tell which chunks and pairs occur again, and where first.
* Lines that are in such chunks are then compared by bytes: of each hash the distinct lines are
  counted, and where one hash stands for different lines nothing is removed because of it.
* What a document loses is a set of line numbers.  Texts are shuffled to meet their lines, once to
  compare them and once to take them out, and only those of documents with such lines: a bitmap of
  their keys, 8 MB at most whatever the table, goes out to the tasks and lets the others pass.

Defined cases: a null text stays null; documents of which nothing is left keep an empty text and
stay; rows without an id come first; rows that share id and text are one document, which keeps or
loses its lines in all of them alike, and rows that share only the id are told apart by text; an
empty table gives an empty result; a document's line hashes are one row, 20 bytes a line, and all
work on them is in proportion to the lines; other columns stay, and clashing result columns
replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.llm.columns import let, words_of
from vecspark.sources.workspace import materialize

#: Places between lines for one that is a candidate.
MEAN_LINES = 2
#: Words that a chunk of several lines needs to be removed.
MIN_WORDS = 10
#: Words that make a single line a passage, and a chunk of its own.
PASSAGE_WORDS = 50

#: Tasks that the occurrences of one chunk are dealt to at least.
SALTS = 4

#: Bits that tell which documents have repeated lines, in rows of as many as Spark's bitmaps have.
BITS, ROW_BITS = 1 << 26, 1 << 15


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_facts(text: Column) -> Column:
    """Two hashes and the number of words of every line."""
    return F.transform(
        lines_of(text),
        lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit("more"), x).alias("b"), F.size(words_of(x)).alias("w")
        ),
    )


def chunk_starts(facts: Column, mean_lines: int) -> Column:
    """The lines that chunks begin with, in order."""

    def candidate(i: Column) -> Column:
        """Whether the place before line ``i`` may be a border."""
        rolling = F.xxhash64(F.coalesce(F.get(facts, i - 2)["a"], F.lit(0).cast("long")), F.get(facts, i - 1)["a"])
        return (i > 0) & (F.pmod(rolling, F.lit(mean_lines)) == 0)

    return F.filter(
        F.sequence(F.lit(0), F.size(facts) - 1), lambda i: (i == 0) | (candidate(i) & ~candidate(i - 1))
    )


def units_of(facts: Column, mean_lines: int, min_words: int, passage_words: int) -> Column:
    """First line, number of lines and hashes of each chunk, pair and long line that may be removed.

    A chunk of two lines that aren't blank is a pair.
    """
    numbers = F.sequence(F.lit(0), F.size(facts) - 1)

    def unit(at: Column, n: Column) -> Column:
        inside = F.slice(facts, at + 1, n)
        return F.struct(at.alias("at"), n.alias("n"), F.concat(inside["a"], inside["b"]).alias("hashes"))

    def words(at: Column, n: Column) -> Column:
        return F.aggregate(F.slice(facts, at + 1, n), F.lit(0), lambda total, f: total + f["w"])

    def full(at: Column, n: Column) -> Column:
        return F.size(F.filter(F.slice(facts, at + 1, n), lambda f: f["w"] > 0))

    def chunks(starts: Column) -> Column:
        spans = F.transform(
            starts, lambda s, k: F.struct(s.alias("at"), (F.coalesce(F.get(starts, k + 1), F.size(facts)) - s).alias("n"))
        )
        return F.filter(spans, lambda u: (words(u["at"], u["n"]) >= min_words) & (full(u["at"], u["n"]) > 2))

    def pairs(at: Column) -> Column:
        spans = F.transform(
            F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0))),
            lambda i, k: F.struct(i.alias("at"), (F.get(at, k + 1) - i + 1).alias("n")),
        )
        return F.filter(
            spans, lambda u: F.get(facts, u["at"])["w"] + F.get(facts, u["at"] + u["n"] - 1)["w"] >= min_words
        )

    long = F.transform(
        F.filter(numbers, lambda i: F.get(facts, i)["w"] >= passage_words),
        lambda i: F.struct(i.alias("at"), F.lit(1).alias("n")),
    )
    spans = F.concat(
        let(chunk_starts(facts, mean_lines), chunks),
        let(F.filter(numbers, lambda i: F.get(facts, i)["w"] > 0), pairs),
        long,
    )
    return F.transform(spans, lambda u: unit(u["at"], u["n"]))


def holders(rows: DataFrame, key: list[str]) -> DataFrame:
    """A bitmap of the keys of ``rows``, at most ``BITS`` long: ``_part`` and ``_bits``."""
    place = F.pmod(F.xxhash64(*key), F.lit(BITS))
    parts = rows.select((place % ROW_BITS).alias("_bit"), F.floor(place / ROW_BITS).alias("_part"))
    return materialize(parts.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "holders")


def may_hold(rows: DataFrame, bitmap: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``_held``: false where the key is surely not in the bitmap."""
    place = F.pmod(F.xxhash64(*key), F.lit(BITS))
    found = rows.withColumns({"_place": place % ROW_BITS, "_part": F.floor(place / ROW_BITS)})
    # Its size is bounded, so it is sent to every task.
    found = found.join(F.broadcast(bitmap), "_part", "left")
    octet = F.conv(F.hex(F.expr("substring(_bits, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    held = F.coalesce(F.getbit(octet, (F.col("_place") % 8).cast("int")) == 1, F.lit(False))
    return found.withColumn("_held", held).drop("_part", "_bits", "_place")


def remove_repeated_lines(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mean_lines: int = MEAN_LINES,
    min_words: int = MIN_WORDS,
    passage_words: int = PASSAGE_WORDS,
    report: bool = False,
) -> DataFrame:
    """The documents without repeated chunks; with ``report``, also ``n_lines``,
    ``n_removed_lines`` and ``removed_text``."""
    doc = F.col("_row")[id_col].cast("string")
    text = F.col("_row")[text_col]

    def keyed(columns: list[str]) -> DataFrame:
        """Rows with the key of their document: its id, and its text by 128 bits."""
        found = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
        return found.withColumns(
            {"_doc": doc, "_text": F.xxhash64(text), "_more": F.xxhash64(F.lit("more"), text)}
        )

    rows, narrow = keyed(documents.columns), keyed([id_col, text_col])
    key = ["_doc", "_text", "_more"]

    def by_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
        left, right = left.alias("a"), right.alias("b")
        same = F.col("a._doc").eqNullSafe(F.col("b._doc"))
        for name in key[1:]:
            same = same & (F.col(f"a.{name}") == F.col(f"b.{name}"))
        own = [c for c in right.columns if c not in key]
        return left.join(right, same, how).select("a.*", *[f"b.{c}" for c in own])

    units = let(line_facts(text), lambda facts: units_of(facts, mean_lines, min_words, passage_words))
    # A unit is known by the hashes of all its lines; ids are ordered as they are, not as text.
    found = narrow.filter(text.isNotNull()).select(*key, F.col("_row")[id_col].alias("id"), F.explode(units).alias("unit"))
    place = F.struct("id", F.col("_text").alias("text"), F.col("_more").alias("more"), F.col("unit.at").alias("at"))
    found = materialize(found.select(*key, place.alias("place"), "unit.n", "unit.hashes"), "units")
    repeated = (
        found.groupBy("hashes")
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("hashes", "first")
    )
    # Both sides are dealt anew, so that Spark can split a chunk that very many documents share.
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    salted = found.withColumn("salt", F.pmod("_text", F.lit(SALTS)).cast("int"))
    again = salted.join(repeated.withColumn("salt", F.explode(salts)), ["hashes", "salt"])
    # Every line of these once, and whether it stands in one that isn't the first.
    line = F.posexplode(F.slice("hashes", F.lit(1), F.col("n"))).alias("k", "a")
    lines = again.select(*key, "n", "hashes", "place", (F.col("place") != F.col("first")).alias("later"), line)
    number, second = (F.col("place.at") + F.col("k")).alias("line"), F.get("hashes", F.col("n") + F.col("k")).alias("b")
    marked = materialize(
        lines.select(*key, number, "a", second, "later").groupBy(*key, "line", "a", "b").agg(F.max("later").alias("later")),
        "marked-lines",
    )

    # Hashes that stand for different lines: with 128 bits almost surely none.
    shared = marked.groupBy(*key).agg(F.collect_list("line").alias("shared"))
    bitmap = holders(marked, key)
    held = by_key(may_hold(narrow, bitmap, key).filter("_held"), shared, "inner")
    texts = held.select(F.explode(let(lines_of(text), lambda ls: F.transform("shared", lambda i: F.get(ls, i)))).alias("line"))
    hashes = (F.xxhash64("line").alias("a"), F.xxhash64(F.lit("more"), "line").alias("b"))
    unlike = texts.select(*hashes, "line").distinct().groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    removed = marked.filter("later").join(unlike, ["a", "b"], "left_anti")
    removed = removed.groupBy(*key).agg(F.collect_list("line").alias("removed"))
    rows = may_hold(rows, bitmap, key)
    others = rows.filter("NOT _held").withColumn("removed", F.lit(None).cast("array<int>"))
    result = by_key(rows.filter("_held"), removed).unionByName(others)

    kept = let(
        lines_of(text),
        lambda ls: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "removed"), lambda i: F.get(ls, i)), "\n"
        ),
    )
    kept_text = F.when(F.col("removed").isNull(), text).otherwise(kept)
    added = {}
    if report:
        taken = F.coalesce("removed", F.array().cast("array<int>"))
        added = {
            "n_lines": F.coalesce(F.size(lines_of(text)), F.lit(0)),
            "n_removed_lines": F.size(taken),
            "removed_text": let(
                lines_of(F.coalesce(text, F.lit(""))),
                lambda ls: F.array_join(F.transform(F.sort_array(taken), lambda i: F.get(ls, i)), "\n"),
            ),
        }
    return result.select(
        *[(kept_text if c == text_col else F.col("_row")[c]).alias(c) for c in documents.columns if c not in added],
        *[c.alias(name) for name, c in added.items()],
    )
