"""Registered queries of the subpackage, and the SQL that they agree with where SQL can say it."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm.bpe import encode_and_decode
from vecspark.llm.centroid_clustering import cluster_report
from vecspark.llm.class_lm import learn_and_score
from vecspark.llm.html_text import extract_text
from vecspark.llm.language_id import identify_language, learn_profiles
from vecspark.llm.line_dedup import remove_repeated_lines
from vecspark.llm.merkle import compare_with_next
from vecspark.llm.near_dedup import near_duplicates
from vecspark.llm.oracles import CENTROID_CLUSTERING, NEAR_DEDUP, PREFIX_TRIE, QUALITY_RULES
from vecspark.llm.packing import pack
from vecspark.llm.prefix_trie import ordered_turns, prefix_trie
from vecspark.llm.quality import judge, measure
from vecspark.llm.token_counts import count_tokens
from vecspark.llm.toxicity import find_terms, labelled_texts, learn_lexicon, learn_weights, one_label
from vecspark.llm.toxicity import score as score_toxicity
from vecspark.sources.workspace import materialize

TOKENIZER = "word_bpe_49k.json"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def fold(folds: int) -> Column:
    """The fold of a document, by the checksum of its id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder), k=4)


def op2_merkle_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return compare_with_next(documents(spark, folder))


def op3_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    found = learn_and_score(documents(spark, folder).select("doc_id", "text"), fold(5) != 1)
    return found.withColumn("held_out", fold(5) == 1)


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{folder}/pages.parquet"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return count_tokens(docs, tokenizer_path(TOKENIZER))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    profiles = learn_profiles(docs.filter(fold(4) != 2))
    found = identify_language(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), tokenizer_path(TOKENIZER))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "source")
    measured = materialize(measure(docs).drop("text"), "measured")
    return judge(measured).drop("source")


def op9_bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return encode_and_decode(docs, tokenizer_path(TOKENIZER))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return remove_repeated_lines(docs, report=True)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(fold(4) != 2)
    lexicon = learn_lexicon(labelled_texts(docs, labels))
    found = materialize(find_terms(docs, lexicon), "terms")
    scored = score_toxicity(found, learn_weights(found, one_label(labels)))
    return scored.withColumn("held_out", fold(4) == 2)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(with_shared_heads(spark.read.parquet(f"{folder}/conversations.parquet")))


def with_shared_heads(conversations: DataFrame, apart: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin like the one whose id is the next multiple of ``apart`` below, for
    fewer turns than ``heads`` by the checksum of their id; ``conv_id`` and ``steps``."""
    own = materialize(ordered_turns(conversations), "turns")
    base = own.filter(F.col("conv_id") % apart == 0)
    base = base.select(F.col("conv_id").alias("base_id"), F.slice("steps", 1, heads - 1).alias("head"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    joined = own.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % apart).join(base, "base_id", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), taken)
    return joined.select("conv_id", F.concat(head, F.slice("steps", taken + 1, F.size("steps"))).alias("steps"))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_report(spark.read.parquet(f"{folder}/embeddings.parquet"))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_merkle_fingerprint": op2_merkle_fingerprint,
    "op3_class_lm": op3_class_lm,
    "op4_html_text": op4_html_text,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe_roundtrip": op9_bpe_roundtrip,
    "op10_line_dedup": op10_line_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_centroid_clustering": op13_centroid_clustering,
}
ORACLES = {
    "op1_minhash_near_dedup": NEAR_DEDUP,
    "op8_quality_rules": QUALITY_RULES,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_centroid_clustering": CENTROID_CLUSTERING,
}
