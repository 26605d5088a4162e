"""Arrow batches of texts: bounded slices, and words as codes into the distinct words of a slice."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that is worked on at a time. A single longer text makes a slice of its own.
SLICE_BYTES = 8 << 20


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches with their texts, nulls as empty, of about ``max_bytes`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size) - size) // max_bytes
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start), texts.slice(start, end - start)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words per text, the code of each word in order, and the distinct words by code.

    A word is a run of characters other than space, tab, line feed, vertical tab, form feed
    and carriage return.
    """
    lists = pc.ascii_split_whitespace(texts)
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = encoded.dictionary.to_pylist()
    if "" in words:
        empty = words.index("")
        real = codes != empty
        per_text = np.bincount(
            np.repeat(np.arange(len(per_text)), per_text)[real], minlength=len(per_text)
        )
        codes = codes[real]
    return per_text, codes, words


def spans(per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one position of each text in the flat arrays."""
    ends = np.cumsum(per_text)
    return ends - per_text, ends


def ragged_take(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``values[first : first + count]`` one after another."""
    total = int(count.sum())
    shift = np.repeat(first - (np.cumsum(count) - count), count)
    return values[np.arange(total) + shift]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (multiply and shift, three times)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema
    )
