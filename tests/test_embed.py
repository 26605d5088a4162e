"""Encoders: alignment, blanks, failures and the hashing encoder."""

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vecspark.operators.embed import ENCODE_BYTES, _parts, embed, hash_embed, zero_fallback

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIM = 16


def lengths_encoder():
    def encode(texts):
        return np.array([[len(t), 1.0] for t in texts.to_pylist()])

    return encode


def broken_encoder():
    def encode(texts):
        if any("boom" in t for t in texts.to_pylist()):
            raise RuntimeError("no model")
        return np.ones((len(texts), 2))

    return encode


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string").coalesce(1)


def test_one_output_per_input(spark):
    values = ["abc", None, "", " \t\n", "x" * 5000, "héé"]
    rows = embed(texts(spark, values), "text", lengths_encoder, 2, batch_size=2).orderBy("id").collect()
    assert [r.text for r in rows] == values
    assert [r.embed_status for r in rows] == ["ok", "blank", "blank", "blank", "ok", "ok"]
    assert [r.embedding for r in rows] == [[3, 1], [0, 0], [0, 0], [0, 0], [5000, 1], [3, 1]]


def test_failures_become_zero_or_raise(spark):
    df = texts(spark, ["fine", "boom", "fine"])
    rows = embed(df, "text", broken_encoder, 2, batch_size=1).orderBy("id").collect()
    assert [r.embed_status for r in rows] == ["ok", "failed", "ok"]
    assert rows[1].embedding == [0, 0]
    with pytest.raises(Exception, match="no model"):
        embed(df, "text", broken_encoder, 2, on_error="raise").collect()
    wrong = embed(df, "text", lengths_encoder, 3).collect()
    assert {r.embed_status for r in wrong} == {"failed"}


def test_one_bad_text_costs_one_row(spark):
    values = ["fine"] * 299 + ["boom"]
    rows = embed(texts(spark, values), "text", broken_encoder, 2, error_col="error").collect()
    failed = [r for r in rows if r.embed_status != "ok"]
    assert [(r.text, r.embed_status, r.error) for r in failed] == [("boom", "failed", "RuntimeError: no model")]
    assert all(r.embedding == [1, 1] for r in rows if r.embed_status == "ok") and len(rows) == 300


def test_hashing_matches_definition(spark):
    values = ["Hello world hello", "", "world  HELLO hello", "other"]
    rows = hash_embed(texts(spark, values), "text", DIM).orderBy("id").collect()

    def expected(text):
        v = np.zeros(DIM)
        for token in text.lower().split():
            h = hashlib.md5(token.encode()).hexdigest()
            v[int(h[:8], 16) % DIM] += 1 if h[8] < "8" else -1
        norm = np.sqrt((v * v).sum())
        return (v / norm if norm else v).astype(np.float32).tolist()

    assert [r.embedding for r in rows] == [expected(t) for t in values]
    assert rows[0].embedding == rows[2].embedding != rows[3].embedding
    assert [r.embed_status for r in rows] == ["ok", "blank", "ok", "ok"]
    assert hash_embed(texts(spark, []), "text", DIM).count() == 0


def test_related_texts_are_closer(spark):
    from vecspark.functions.vectors import cosine_similarity

    df = hash_embed(
        texts(spark, ["cats are small animals", "cats are pets and animals", "quantum field theory"]), "text", 64
    )
    v = {r.id: r.embedding for r in df.collect()}
    pair = spark.createDataFrame([(v[0], v[1], v[2])], "a array<float>, b array<float>, c array<float>")
    near, far = pair.select(cosine_similarity("a", "b"), cosine_similarity("a", "c")).first()
    assert near > far


def test_zero_fallback(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<float>")
    rows = {r.id: (r.v, r.embed_status) for r in zero_fallback(df, "v", 2).collect()}
    assert rows == {1: ([1.0, 2.0], "ok"), 2: ([0.0, 0.0], "missing")}
    assert zero_fallback(df, "v", 2).filter(F.size("v") == 2).count() == 2


def test_an_encoder_gets_texts_by_bytes():
    values = pa.array(["x" * 1000] * 3000 + [None, " "] + ["y" * (ENCODE_BYTES + 1), "z"])
    filled = np.flatnonzero([v is not None and v.strip() != "" for v in values.to_pylist()])
    parts = _parts(values, filled, 4096)
    assert np.concatenate(parts).tolist() == filled.tolist()
    sizes = [sum(len(values[i].as_py()) for i in part.tolist()) for part in parts]
    assert max(sizes) <= 2 * ENCODE_BYTES + 1 and len(parts) >= 3
    assert [len(p) for p in _parts(pa.array(["a"] * 10), np.arange(10), 4)] == [4, 4, 2]
    assert _parts(pa.array([], pa.string()), np.arange(0), 4) == []
