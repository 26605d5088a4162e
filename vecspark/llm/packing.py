"""Bounded-space online packing of token ids into windows of fixed size.

Every task keeps ``open_windows`` windows.  The ids of a document, closed by an end id, first
fill whole windows; the rest goes to the open window that it fits best, and if it fits none the
fullest is emitted and a new one opened.  At its end a task cuts what its emptiest windows hold
to fill the fullest, so that one window at most is left over.  Leftovers are merged by the same
placement, window by window, over ever fewer tasks of bounded size.

Ids never leave the task that made them: the result names the pieces, with a checksum of the
ids of each.

Defined cases: a null or empty text is a document of the end id alone; rows without an id or
with the same id are packed each by itself; an empty table gives no windows; other columns are
not carried over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.batches import spans, text_slices
from vecspark.llm.wordpieces import TOKEN_SLICE_BYTES, PieceEncoder
from vecspark.sources.workspace import materialize

#: Windows that a task keeps open.
OPEN_WINDOWS = 64
#: Open windows that one task merges at most; larger numbers are merged in several rounds.
MERGED_AT_ONCE = 8_192
MAX_MERGE_TASKS = 1 << 24

_PIECE_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset")
PIECE = T.StructType([T.StructField(name, T.LongType()) for name in _PIECE_FIELDS])
WINDOW = T.StructType(
    [
        T.StructField("window", T.LongType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("fill", T.LongType()),
        T.StructField("pieces", T.ArrayType(PIECE)),
    ]
)


@dataclass
class Window:
    fill: int = 0
    pieces: list[dict] = field(default_factory=list)

    def add(self, pieces: Iterable[dict], length: int) -> None:
        self.pieces.extend(pieces)
        self.fill += length


class OpenWindows:
    """A fixed number of open windows with best-fit placement."""

    def __init__(self, size: int, capacity: int):
        self.size, self.capacity = size, capacity
        self.open: list[Window] = []

    def place(self, pieces: list[dict], length: int) -> Window | None:
        """Place pieces that stay together; the window that had to be emitted, or one that
        they filled."""
        fitting = [w for w in self.open if w.fill + length <= self.size]
        if fitting:
            best = max(fitting, key=lambda w: w.fill)
            best.add(pieces, length)
            if best.fill == self.size:
                self.open.remove(best)
                return best
            return None
        emitted = None
        if len(self.open) >= self.capacity:
            emitted = max(self.open, key=lambda w: w.fill)
            self.open.remove(emitted)
        self.open.append(Window(length, list(pieces)))
        return emitted


def fill_up(windows: list[Window], size: int) -> list[Window]:
    """The same ids in windows of which all but one are full: the emptiest are cut up."""
    windows = sorted(windows, key=lambda w: w.fill)
    full = []
    while len(windows) > 1:
        donor, window = windows[0], windows[-1]
        piece, gap = donor.pieces[-1], size - window.fill
        cut = max(len(piece["ids"]) - gap, 0)
        moved = piece | {"start": piece["start"] + cut, "ids": piece["ids"][cut:]}
        window.add([moved], len(moved["ids"]))
        donor.fill -= len(moved["ids"])
        piece["ids"] = piece["ids"][:cut]
        if not cut:
            donor.pieces.pop()
        if not donor.fill:
            windows.pop(0)
        if window.fill == size:
            full.append(windows.pop())
    return full + windows


class _Output:
    """Windows as record batches, numbered within the task."""

    def __init__(self, round_no: int):
        self.schema = pa.schema(
            [
                ("window", pa.int64()),
                ("closed", pa.bool_()),
                ("fill", pa.int64()),
                ("pieces", pa.list_(pa.struct([(name, pa.int64()) for name in _PIECE_FIELDS]))),
            ]
        )
        # Rounds (below 2^5), tasks (2^24) and windows (2^34) have their own bits of the number.
        self.number = (round_no << 58) | (TaskContext.get().partitionId() << 34)
        self.rows: list[dict] = []

    def add(self, window: Window, closed: bool) -> None:
        offset = 0
        for piece in window.pieces:
            if (ids := piece.pop("ids", None)) is not None:
                piece |= {"length": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
            piece["offset"] = offset
            offset += piece["length"]
        self.rows.append(
            {"window": self.number, "closed": closed, "fill": window.fill, "pieces": window.pieces}
        )
        self.number += 1

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            rows, self.rows = self.rows, []
            yield pa.RecordBatch.from_pylist(rows, schema=self.schema)


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    window_tokens: int = 2048,
    end_id: int = 1,
    open_windows: int = OPEN_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Windows of one pass: closed ones, and those that the tasks still had open."""
    source = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )

    def run(batches):
        encoder, windows = PieceEncoder(tokenizer), OpenWindows(window_tokens, open_windows)
        out = _Output(0)
        for batch, texts in text_slices(batches, "text", TOKEN_SLICE_BYTES):
            doc_ids = batch.column(0).to_pylist()
            count, flat = encoder.encode(texts)
            first, last = spans(count)
            for doc_id, a, b in zip(doc_ids, first.tolist(), last.tolist(), strict=True):
                ids = np.append(flat[a:b], end_id).astype("<u4")
                for start in range(0, len(ids), window_tokens):
                    part = ids[start : start + window_tokens]
                    piece = {
                        "doc_id": doc_id, "start": start, "ids": part, "doc_tokens": len(ids)
                    }
                    if len(part) == window_tokens:
                        out.add(Window(len(part), [piece]), True)
                    elif (full := windows.place([piece], len(part))) is not None:
                        out.add(full, True)
                yield from out.batches(1_000)
        for window in fill_up(windows.open, window_tokens):
            out.add(window, window.fill == window_tokens)
        yield from out.batches()

    return source.mapInArrow(run, WINDOW)


def merge_open(
    windows: DataFrame,
    round_no: int,
    window_tokens: int = 2048,
    open_windows: int = OPEN_WINDOWS,
    last: bool = False,
) -> DataFrame:
    """Put windows that are not full together, by the rule that places documents."""

    def run(batches):
        held, out = OpenWindows(window_tokens, open_windows), _Output(round_no)
        for batch in batches:
            for row in batch.to_pylist():
                if (full := held.place(row["pieces"], row["fill"])) is not None:
                    out.add(full, True)
            yield from out.batches(1_000)
        for window in held.open:
            out.add(window, last)
        yield from out.batches()

    return windows.mapInArrow(run, WINDOW)


def pack(
    documents: DataFrame,
    tokenizer: str,
    window_tokens: int = 2048,
    end_id: int = 1,
    open_windows: int = OPEN_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    merged_at_once: int = MERGED_AT_ONCE,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence."""
    first = materialize(
        pack_documents(
            documents, tokenizer, window_tokens, end_id, open_windows, id_col, text_col
        ),
        "packed",
    )
    done, left, round_no = [first.filter("closed")], first.filter("NOT closed"), 1
    tasks = 0
    while True:
        # Every task leaves some windows open, so half as many take them up the next time, whatever
        # the parameters are; at most 25 rounds then follow 2^24 tasks.
        wanted = -(-left.count() // merged_at_once)
        tasks = min(wanted, tasks // 2 if tasks else MAX_MERGE_TASKS)
        dealt = left.repartition(tasks, "window") if tasks > 1 else left.coalesce(1)
        # Largest windows first: the small ones then fill the gaps.
        dealt = dealt.sortWithinPartitions(F.desc("fill"), "window")
        merged = materialize(
            merge_open(dealt, round_no, window_tokens, open_windows, tasks <= 1), "merged"
        )
        done.append(merged.filter("closed"))
        if tasks <= 1:
            break
        left, round_no = merged.filter("NOT closed"), round_no + 1
    windows = done[0]
    for part in done[1:]:
        windows = windows.unionByName(part)
    placed = windows.select(F.col("window").alias("sequence_id"), F.explode("pieces").alias("piece"))
    return placed.select("piece.*", "sequence_id")
