"""Quality rules with host verdicts, in DataFrame functions only.

Each document is measured against rules; failures are counted by host, here the column
``source``.  A host's failure rate is shrunk towards the corpus with a beta prior that is fitted
to all hosts by its moments, so a host with few documents is not judged by chance.  A host whose
shrunk rate of any rule is over the limit is rejected, and its verdict is joined back.  A document
that fails the symbol rule is rejected too, unless symbols are usual for its host: its shrunk rate
is several times the corpus rate that the prior is fitted to.

Defined cases: a null or blank text has no words and fails the base rule; a null host is a host
of its own; rows that repeat are measured and counted each by itself; an empty table gives an
empty result; other columns stay, and clashing result columns replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.llm.columns import SPACE, count_without, is_blank, let, words_of
from vecspark.sources.workspace import materialize

#: Characters that stand for markup and decoration.
SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Symbols per 100 characters of words, and repeated lines per 100 lines, that a rule allows.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: Shrunk failure rate over which a host is rejected.
MAX_HOST_RATE = 0.5
#: Shrunk failure rate of the symbol rule, in corpus rates, over which a host excuses its documents.
EXCUSED_RATES = 4.0
#: Strength of the prior when the hosts don't differ, in documents; and its least.
MAX_PRIOR, MIN_PRIOR = 1e6, 1.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("base_failed", "symbols_failed", "lines_failed")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that are found twice or more in the text.

    Windows are told apart by hash first, which proves that a text without equal hashes has no
    repetition; where hashes repeat, the windows themselves are compared.
    """

    def places(ws: Column) -> Column:
        return F.sequence(F.lit(0), F.size(ws) - window)

    def covered(ws: Column) -> Column:
        texts = F.array_sort(
            F.transform(
                places(ws),
                lambda i: F.struct(
                    F.concat_ws(" ", F.slice(ws, i + 1, window)).alias("w"), i.alias("i")
                ),
            )
        )

        def starts(found: Column) -> Column:
            return F.array_sort(
                F.transform(
                    F.filter(
                        found,
                        lambda x, k: F.get(found, k - 1)["w"].eqNullSafe(x["w"])
                        | F.get(found, k + 1)["w"].eqNullSafe(x["w"]),
                    ),
                    lambda x: x["i"],
                )
            )

        zero = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(
            let(texts, starts),
            zero,
            lambda a, i: F.struct(
                i.alias("last"),
                (a["sum"] + F.least(F.lit(window), i - a["last"])).alias("sum"),
            ),
            lambda a: a["sum"],
        )

    def count(ws: Column) -> Column:
        hashes = F.transform(
            places(ws), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(window)])
        )
        unique = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
        return (
            F.when(F.size(ws) <= window, F.lit(0).cast("long"))
            .when(unique, F.lit(0).cast("long"))
            .otherwise(covered(ws))
        )

    return let(words, count)


def measure(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the measures of their texts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~is_blank(x))
    words = words_of(text)
    of_words = let(
        words,
        lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeated_words(ws).alias("r")),
    )
    of_lines = let(
        lines,
        lambda ls: F.struct(
            F.size(ls).cast("long").alias("n"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("d"),
        ),
    )
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in MEASURES]
    return documents.select(
        *kept,
        of_words.alias("_words"),
        of_lines.alias("_lines"),
        count_without(text, SPACE).cast("long").alias("word_chars"),
        (F.char_length(text) - count_without(text, SYMBOLS)).cast("long").alias("n_symbols"),
    ).select(
        *kept,
        F.col("_words.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.n").alias("n_lines"),
        F.col("_lines.d").alias("n_dup_lines"),
        F.col("_words.r").alias("n_repeat_words"),
    )


def apply_rules(measured: DataFrame) -> DataFrame:
    return measured.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
            "symbols_failed": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
            "lines_failed": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        }
    )


def host_verdicts(judged: DataFrame, host_col: str = "source") -> DataFrame:
    """Per host: documents, the shrunk failure rate of each rule, whether it is rejected, and
    whether it excuses symbols.

    The prior's mean is the corpus rate; its strength follows from how much more the hosts'
    rates differ than the numbers of their documents explain.
    """
    hosts = judged.groupBy(F.col(f"`{host_col}`").alias("_host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.count_if(F.col(rule)).alias(rule) for rule in RULES],
    )
    rates = {rule: F.col(rule) / F.col("n_docs") for rule in RULES}
    totals = hosts.agg(
        F.sum("n_docs").alias("docs"),
        F.count(F.lit(1)).alias("hosts"),
        *[(F.sum(rule) / F.sum("n_docs")).alias(f"{rule}_mean") for rule in RULES],
        *[F.sum(F.col("n_docs") * rate * rate).alias(f"{rule}_square") for rule, rate in rates.items()],
    )
    strengths = []
    for rule in RULES:
        mean = F.col(f"{rule}_mean")
        binomial = mean * (1 - mean)
        between = F.col(f"{rule}_square") / F.col("docs") - mean * mean
        excess = between - binomial * F.col("hosts") / F.col("docs")
        strength = F.when(excess > 0, binomial / excess - 1).otherwise(MAX_PRIOR)
        strengths.append(
            F.greatest(F.lit(MIN_PRIOR), F.least(F.lit(MAX_PRIOR), strength)).alias(f"{rule}_prior")
        )
    prior = totals.select(*[f"{rule}_mean" for rule in RULES], *strengths)
    # One row of six numbers, as a scalar.
    fitted = prior.select(F.struct("*")).scalar()
    shrunk = hosts.withColumn("_prior", fitted).select(
        "_host",
        "n_docs",
        *[
            (
                (F.col(rule) + F.col(f"_prior.{rule}_prior") * F.col(f"_prior.{rule}_mean"))
                / (F.col("n_docs") + F.col(f"_prior.{rule}_prior"))
            ).alias(f"{rule}_rate")
            for rule in RULES
        ],
        F.col("_prior.symbols_failed_mean").alias("_mean"),
    )
    excused = F.col("symbols_failed_rate") > EXCUSED_RATES * F.col("_mean")
    worst = F.greatest(*[F.col(f"{rule}_rate") for rule in RULES])
    verdicts = shrunk.withColumns({"host_rejected": worst > MAX_HOST_RATE, "symbols_excused": excused})
    return verdicts.drop("_mean")


def judge(measured: DataFrame, host_col: str = "source") -> DataFrame:
    """Measured documents with their failures, the host's verdicts and ``kept``.

    ``measured`` should be stored: it is read for the hosts and again for the documents.
    """
    added = ("base_failed", "symbols_failed", "host_rejected", "symbols_excused", "kept")
    judged = apply_rules(measured)
    hosts = host_verdicts(judged, host_col).select(
        "_host", F.col("host_rejected").alias("_rejected"), F.col("symbols_excused").alias("_excused")
    )
    joined = judged.join(hosts, F.col(f"`{host_col}`").eqNullSafe(F.col("_host")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in measured.columns if c not in added],
        "base_failed",
        "symbols_failed",
        F.col("_rejected").alias("host_rejected"),
        F.col("_excused").alias("symbols_excused"),
        passes(F.col("_rejected"), F.col("_excused")).alias("kept"),
    )


def passes(host_rejected: Column, symbols_excused: Column) -> Column:
    """Whether a document with the failures of ``apply_rules`` stays under its host's verdicts."""
    return ~F.col("base_failed") & ~host_rejected & (~F.col("symbols_failed") | symbols_excused)


def filter_documents(documents: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that pass, with their own columns."""
    columns = documents.columns
    row = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    measured = measure(
        row.select("_row", F.col(f"_row.`{text_col}`").alias("_text"), F.col(f"_row.`{host_col}`").alias("_source")),
        "_text",
    ).drop("_text")
    hosts = materialize(
        host_verdicts(apply_rules(measured.drop("_row")), "_source").select("_host", "host_rejected", "symbols_excused"),
        "hosts",
    )
    judged = apply_rules(measured).join(hosts, F.col("_source").eqNullSafe(F.col("_host")))
    return judged.filter(passes(F.col("host_rejected"), F.col("symbols_excused"))).select("_row.*")
