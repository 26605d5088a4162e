"""Token counts of documents of any length by overlap resynchronisation.

A text longer than ``chunk_chars`` is never encoded whole.  It is cut into chunks that
overlap; each chunk is encoded with the offsets of its tokens, and two neighbours are spliced
at a boundary that both agree on and that is proven stable: a token starts there in either
chunk and the character before it is white space, over which nothing in the tokenizer reaches.
Where the overlap holds no such place it is doubled, at last to both whole chunks.

A text of one chunk needs no splice.  All white space in it is a stable boundary, so each
distinct piece between two of them is encoded once for a whole batch.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows are counted each
by itself; other columns stay as they are, and result columns that clash with them replace
them; an empty table gives an empty result.  Neither begin, end nor other special tokens are
added; special strings inside a text become the special token, as the library does by default.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.batches import text_slices
from vecspark.llm.wordpieces import TOKEN_SLICE_BYTES, PieceEncoder

#: Longest text, in code points, that is encoded in one piece.
CHUNK_CHARS = 32_768
#: Code points that two neighbouring chunks share at first.
OVERLAP_CHARS = 512

_SPACE = " \t\n\v\f\r"


def token_starts(library, text: str, shift: int) -> np.ndarray:
    """Offsets, in the whole document, at which the tokens of a chunk start."""
    offsets = library.encode(text, add_special_tokens=False).offsets
    return np.array([start for start, _ in offsets], np.int64) + shift


def stable_boundary(text: str, left: np.ndarray, right: np.ndarray, begin: int, end: int) -> int:
    """The token start nearest the middle of ``[begin, end)`` that both chunks have, after
    white space; -1 if there is none."""
    both = np.intersect1d(left[left >= begin], right[right < end])
    both = [p for p in both.tolist() if begin < p and text[p - 1] in _SPACE]
    return min(both, key=lambda p: abs(2 * p - begin - end), default=-1)


def spliced_count(library, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text``, counted chunk by chunk."""
    begin, end, counted = 0, min(chunk, len(text)), 0
    left = token_starts(library, text[:end], 0)
    while end < len(text):
        width = overlap
        while True:
            next_begin = max(begin, end - width)
            next_end = min(len(text), next_begin + chunk + width)
            right = token_starts(library, text[next_begin:next_end], next_begin)
            splice = stable_boundary(text, left, right, next_begin, end)
            if splice >= 0:
                break
            if next_begin == begin:  # no boundary in all of the left chunk: it takes in the right
                end = next_end
                left = right
                if end == len(text):
                    break
            width *= 2
        if splice < 0:
            break
        counted += int((left < splice).sum())
        left, begin, end = right[right >= splice], splice, next_end
    return counted + len(left)


def count_tokens(
    documents: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    limit: int = 2048,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """All columns but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    added = {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}
    kept = [c for c in documents.columns if c != text_col and c not in added]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        encoder = PieceEncoder(tokenizer)
        for batch, texts in text_slices(batches, "_text", TOKEN_SLICE_BYTES):
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
            long = np.flatnonzero(chars > chunk_chars)
            tokens = encoder.counts(pc.if_else(pa.array(chars > chunk_chars), "", texts))
            for i in long:
                text = texts[int(i)].as_py()
                tokens[i] = spliced_count(encoder.library, text, chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array(size, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(tokens > limit),
                ],
                names=[*kept, *added],
            )

    schema = source.drop("_text").schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return source.mapInArrow(run, schema)
