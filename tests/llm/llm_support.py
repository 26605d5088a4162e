"""Small tables and brute-force versions for the tests of the llm subpackage."""

import os
import random

from public_tokenizers import path as tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = tokenizer_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
HAS_TABLES = os.path.isdir(FOLDER)


def docs(spark, rows):
    """Documents from (id, text) or (id, text, lang, source)."""
    full = [(*r, *(None, None)[len(r) - 2 :], len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(rng, n, words=None):
    return " ".join(rng.choice(words) if words else "".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def odd_texts():
    """Empty, blank, long, repeated and strange texts."""
    rng = random.Random(7)
    return [
        None, "", " \t\n\v\f\r ", "a", "A a", "\n\n", "x\ny\n", "é", "é", "日本語 テキスト", "😀😀 👍🏽",
        "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "ŒŸİΣς ǅ ﬁ", "z" * 5_000, "don't 12 $%& 's",
        sentence(rng, 4_000), "same line here\n" * 300, " lead and trail ", "tab\tand\x1cseparator\x85next\xa0space",
        "\x00nul", "same line here\n" * 300,
    ]


def edge_frame(spark):
    """The odd texts with nulls everywhere, repeated ids and repeated rows."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}") for i, t in enumerate(odd_texts())]
    rows += [(None, "no id at all", None, None), (None, None, None, None), (3, "another text of id three", "en", "s1"), rows[4], rows[4]]
    return docs(spark, rows)


def words_of(text):
    return (text or "").encode().lower().split()
