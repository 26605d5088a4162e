"""From raw documents to packed windows: the stages of a training-data pipeline.

Each stage takes all that its predecessor kept.  All but the last return the columns of the
documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm.language_id import UNDETERMINED, identify_language, learn_profiles
from vecspark.llm.line_dedup import remove_repeated_lines
from vecspark.llm.near_dedup import keep_one
from vecspark.llm.packing import pack
from vecspark.llm.quality import filter_documents
from vecspark.sources.workspace import materialize

TOKENIZER = "word_bpe_49k.json"
#: Nearness to a language's profile under which a text is in none of the languages.
MIN_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents are in."""
    columns = docs.columns
    others = [c for c in columns if c != "text"]
    rows = docs.select(F.struct(*[f"`{c}`" for c in others]).alias("row"), "text")
    judged = identify_language(rows, learn_profiles(docs))
    kept = judged.filter(
        (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    )
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule, and the symbol rule unless their host excuses it, of
    hosts that are not rejected."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that are found earlier; lengths follow."""
    result = remove_repeated_lines(docs)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents are packed into."""
    return pack(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("packing", packing),
]

#: Stages learn and tokenise, which SQL can't express; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
