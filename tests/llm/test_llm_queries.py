"""Registered queries of the subpackage on the smallest supplied tables."""

import hashlib
import re
import zlib

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from llm_support import FOLDER, HAS_TABLES, TOKENIZER
from test_llm_dedup import brute_line_dedup, brute_next
from test_llm_models import plain_base
from test_llm_tokens import check_packing
from vecspark.llm.queries import ORACLES, QUERIES

pytestmark = pytest.mark.skipif(not HAS_TABLES, reason="no supplied tables")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


def run(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_all_are_registered():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    with duckdb.connect() as duck:
        for table in ("documents", "conversations", "embeddings"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        want = duck.sql(ORACLES[name])
        columns = want.columns
        want = sorted(want.fetchall(), key=str)
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == want


def test_fingerprints(spark, texts):
    assert sorted(map(tuple, run(spark, "op2_merkle_fingerprint")), key=str) == brute_next(list(texts.items()))


def test_scores(spark, texts):
    rows = list(texts.items())
    count, total, log = plain_base(rows, {i for i in texts if not held_out(i, 5, 1)})
    found = run(spark, "op3_class_lm")
    assert len(found) == len(rows)
    for r in found:
        words = [*texts[r.doc_id].encode().lower().split(), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held_out(r.doc_id, 5, 1), len(words), sum(count[w] > 0 for w in words), total,
        )
        assert r.base_score == pytest.approx(sum(log[w] for w in words), rel=1e-9)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_languages(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet'").fetchall())
    found = run(spark, "op6_language_id")
    assert {r.doc_id: r.held_out for r in found} == {i: held_out(i, 4, 2) for i in lang}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_tokens(spark, texts):
    library = Tokenizer.from_file(TOKENIZER)
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    counted = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op5_token_counts")}
    assert counted == {i: (len(t.encode()), len(ids[i]), len(ids[i]) > 2048) for i, t in texts.items()}
    decoded = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in run(spark, "op9_bpe_roundtrip")}
    assert decoded == {
        i: (len(x), hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()) for i, x in ids.items()
    }
    fills = check_packing(run(spark, "op7_packing"), texts, library, 2048)
    assert sum(fills) > 2048 * (len(fills) - 1)


def test_toxicity(spark, texts):
    found = run(spark, "op11_toxicity")
    assert {r.doc_id: r.held_out for r in found} == {i: held_out(i, 4, 2) for i in texts}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_repeated_lines(spark, texts):
    found = {r.doc_id: r.text for r in run(spark, "op10_line_dedup")}
    assert found == brute_line_dedup(list(texts.items()))
