"""Text to vectors with a pluggable encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions.vectors import zero_vector

#: Bytes of text that an encoder gets at a time, but for a single longer text.
ENCODE_BYTES = 1 << 20

# Takes the non-blank texts of a batch and returns one row for each.
Encoder = Callable[[pa.Array], np.ndarray]


def float_lists(matrix: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as an Arrow list column."""
    n, dim = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)) if dim else None
    if offsets is None:
        return pa.array([[]] * n, type=pa.list_(pa.float32()))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


def hashing_encoder(dim: int) -> Callable[[], Encoder]:
    """Signed feature hashing of whitespace-separated words into unit vectors; needs no model file."""

    def slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = b"".join(hashlib.md5(word.encode("utf-8")).digest() for word in words)
        digests = np.frombuffer(joined, dtype=np.uint8).reshape(len(words), 16)
        leading = np.ascontiguousarray(digests[:, :4]).view(">u4").ravel()
        return (leading % dim).astype(np.int64), np.where(digests[:, 4] < 128, 1.0, -1.0)

    def make() -> Encoder:
        def encode(texts: pa.StringArray) -> np.ndarray:
            trimmed = pc.utf8_trim_whitespace(texts)
            token_lists = pc.split_pattern_regex(trimmed, r"\s+")
            # Each distinct token of the batch is hashed once.
            words = token_lists.flatten().dictionary_encode()
            buckets, signs = slots(words.dictionary.to_pylist())
            used = words.indices.to_numpy(zero_copy_only=False)
            lengths = pc.list_value_length(token_lists).to_numpy(zero_copy_only=False)
            n = len(texts)
            at = np.repeat(np.arange(n), lengths) * dim + buckets[used]
            sums = np.bincount(at, weights=signs[used], minlength=n * dim).reshape(n, dim)
            norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            return np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)

        return encode

    return make


def _filled(values: pa.Array) -> np.ndarray:
    """Row positions whose input is neither null nor blank."""
    lengths = pc.utf8_length(pc.utf8_trim_whitespace(values))
    return np.flatnonzero(lengths.fill_null(0).to_numpy(zero_copy_only=False) > 0)


def _parts(values: pa.Array, filled: np.ndarray, batch_size: int) -> list[np.ndarray]:
    """Rows to encode together: ``batch_size`` at most, and of so many bytes."""
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        lengths = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False)[filled]
        group = (np.cumsum(lengths) - lengths) // ENCODE_BYTES
    else:
        group = np.zeros(len(filled), np.int64)
    cuts = np.flatnonzero(np.diff(group)) + 1
    return [p[i : i + batch_size] for p in np.split(filled, cuts) for i in range(0, len(p), batch_size)]


def embed(
    df: DataFrame,
    input_col: str,
    make_encoder: Callable[[], Encoder],
    dim: int,
    output_col: str = "embedding",
    batch_size: int = 256,
    on_error: str = "zero",
    error_col: str | None = None,
) -> DataFrame:
    """Add a vector of length ``dim`` and ``embed_status`` (``ok``, ``blank`` or ``failed``).

    ``make_encoder`` runs once per task, so models and clients are built inside the worker.
    The output has exactly the input rows: blank inputs, and with ``on_error="zero"`` also
    rows the encoder fails on, get the zero vector.  A batch that fails is tried again row by
    row, so one bad text costs one row.  ``error_col`` names a column for the error's text.
    """
    if on_error not in ("zero", "raise"):
        raise ValueError("on_error is 'zero' or 'raise'")
    position = df.columns.index(input_col)
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(output_col, T.ArrayType(T.FloatType())),
            T.StructField("embed_status", T.StringType()),
        ]
    )
    if error_col:
        schema = schema.add(error_col, T.StringType())
    names = schema.fieldNames()

    def encode(encoder, values: pa.Array, part: np.ndarray) -> np.ndarray:
        encoded = np.asarray(encoder(values.take(pa.array(part))), dtype=np.float32)
        if encoded.shape != (len(part), dim):
            raise ValueError(f"encoder returned {encoded.shape}, not {(len(part), dim)}")
        return encoded

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        for batch in batches:
            values = batch.column(position)
            vectors = np.zeros((len(values), dim), dtype=np.float32)
            status = np.full(len(values), "blank", dtype=object)
            filled = _filled(values)
            errors: list[str | None] = [None] * len(values)
            parts = _parts(values, filled, batch_size)[::-1]
            while parts:
                part = parts.pop()
                try:
                    vectors[part] = encode(encoder, values, part)
                    status[part] = "ok"
                except Exception as error:
                    if on_error == "raise":
                        raise
                    if len(part) > 1:
                        parts += [part[i : i + 1] for i in range(len(part))][::-1]
                        continue
                    status[part] = "failed"
                    errors[part[0]] = f"{type(error).__name__}: {error}"
            columns = [*batch.columns, float_lists(vectors), pa.array(status, type=pa.string())]
            if error_col:
                columns.append(pa.array(errors, type=pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(encode_batches, schema)


def hash_embed(df: DataFrame, text_col: str, dim: int, output_col: str = "embedding") -> DataFrame:
    """Hashing embedding of the words of the whole text, ignoring case."""
    lowered = df.withColumn("_lowered", F.lower(text_col))
    encoded = embed(lowered, "_lowered", hashing_encoder(dim), dim, output_col, batch_size=4096)
    return encoded.drop("_lowered")


def zero_fallback(df: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """Replace a missing vector by zeros and say so in ``embed_status``."""
    missing = F.col(vec_col).isNull()
    return df.withColumn(
        "embed_status", F.when(missing, "missing").otherwise("ok")
    ).withColumn(vec_col, F.coalesce(F.col(vec_col), zero_vector(dim)))
