"""Merkle fingerprints of documents over sections, paragraphs and pieces of paragraphs.

The levels of the tree are the document, sections, paragraphs (lines) and pieces; borders of
sections and pieces follow from the content, so that an edit moves none but those beside it.  A
piece ends at the first word, from its second on, whose checksum falls into one class of five, or
at its twelfth; of longer words each 24 characters count as a word.  A section ends after a line
whose checksum falls into one class of four.  The first twelve words of a document are pieces of
their own, so that short texts have enough of them.  Every inner node is the digest of its children's.

The fingerprint is the tree as text: ``root:section(paragraph(piece.size,...),...)...``.  Equal
roots mean equal texts; where roots differ, the branches that differ say where.  ``likeness`` is
the part of two texts, by their lengths, whose pieces have a partner, and 1 if and only if the
roots are equal.

Defined cases: a null text counts as empty, whose fingerprint is a root without children; two
empty texts are alike by 1, an empty and another one by 0.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vecspark.llm.batches import text_slices

PIECE_WORDS, MOST_PIECE_WORDS, PIECE_CLASSES, SECTION_CLASSES = 2, 12, 5, 4
#: Words at the start of a document that are pieces of their own.
FIRST_WORDS = 12
_ROOT_HEX, _NODE_HEX, _PIECE_HEX = 32, 12, 8
_WORD = re.compile(r"[^ \t\v\f\r]{0,24}[ \t\v\f\r]*")


def _digest(data: bytes, length: int) -> str:
    return hashlib.blake2b(data, digest_size=length // 2).hexdigest()


def pieces_of(paragraph: str, single: int = 0) -> list[str]:
    """Runs of words with borders that follow from the words; joined they are the paragraph.
    The first ``single`` words are pieces of their own."""
    words = _WORD.findall(paragraph)
    pieces, begin = [w for w in words[:single] if w], min(single, len(words))
    for at, word in enumerate(words[begin:], begin):
        size = at - begin + 1
        if size == MOST_PIECE_WORDS or (
            size >= PIECE_WORDS
            and zlib.crc32(word.encode("utf-8", "surrogatepass")) % PIECE_CLASSES == 0
        ):
            pieces.append("".join(words[begin : at + 1]))
            begin = at + 1
    rest = "".join(words[begin:])
    return [*pieces, rest] if rest else pieces


def _line_of(line: str, single: int) -> tuple[str, list[tuple[str, int]], bool]:
    """Digest of a paragraph, its pieces, and whether a section ends after it."""
    data = line.encode("utf-8", "surrogatepass")
    leaves = [
        (_digest(p.encode("utf-8", "surrogatepass"), _PIECE_HEX), len(p)) for p in pieces_of(line, single)
    ]
    return _digest(b"p" + data, _NODE_HEX), leaves, zlib.crc32(data) % SECTION_CLASSES == 0


def fingerprint(text: str, known: dict | None = None) -> str:
    """The tree of a text. Lines are looked up in ``known`` and added to it."""
    known = {} if known is None else known
    if not text:
        return _digest(b"", _ROOT_HEX) + ":"
    sections, lines = [], []
    paragraphs = text.split("\n")
    for number, line in enumerate(paragraphs):
        single = 0 if number else FIRST_WORDS
        if (line, single) not in known:
            known[line, single] = _line_of(line, single)
        digest, leaves, ends = known[line, single]
        lines.append((digest, leaves))
        if ends or number == len(paragraphs) - 1:
            sections.append((_digest("s".join(p for p, _ in lines).encode(), _NODE_HEX), lines))
            lines = []
    whole = hashlib.blake2b(digest_size=_ROOT_HEX // 2)
    for digest, _ in sections:
        whole.update(digest.encode())
    # Digests of paragraphs are short; the text itself makes the root's equality that of texts.
    whole.update(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
    body = ";".join(
        f"{section}({','.join(p + '(' + ','.join(f'{d}.{n:x}' for d, n in leaves) + ')' for p, leaves in lines)})"
        for section, lines in sections
    )
    return f"{whole.hexdigest()}:{body}"


def parse(tree: str) -> tuple[str, list[tuple[str, list[tuple[str, list[tuple[str, int]]]]]]]:
    """Root and branches of a fingerprint."""
    root, _, body = tree.partition(":")
    sections = []
    for section in body.split(";") if body else []:
        digest, _, inner = section[:-1].partition("(")
        lines = []
        for line in inner[:-1].split("),") if inner else []:
            paragraph, _, leaves = line.partition("(")
            found = [leaf.split(".") for leaf in leaves.split(",")] if leaves else []
            lines.append((paragraph, [(d, int(n, 16)) for d, n in found]))
        sections.append((digest, lines))
    return root, sections


def pieces(tree: str) -> tuple[str, Counter]:
    """Root, and the lengths of the pieces by digest."""
    root, sections = parse(tree)
    found: Counter = Counter()
    for _, lines in sections:
        for _, leaves in lines:
            for digest, size in leaves:
                found[digest] += size
    return root, found


def likeness_of(one: tuple[str, Counter], other: tuple[str, Counter]) -> float:
    """Likeness of two trees whose pieces are known: Dice's coefficient by length."""
    if one[0] == other[0]:
        return 1.0
    total = one[1].total() + other[1].total()
    shared = sum(min(n, other[1][d]) for d, n in one[1].items() if d in other[1])
    return min(2 * shared / total, 1 - 1e-9) if total else 0.0


def likeness(one: str, other: str) -> float:
    return likeness_of(pieces(one), pieces(other))


def changed_paragraphs(one: str, other: str) -> list[tuple[int, int]]:
    """Section and paragraph, by number, of what ``one`` has and ``other`` hasn't.

    Branches with equal digests are left out without a look inside.
    """
    (root, sections), (other_root, others) = parse(one), parse(other)
    if root == other_root:
        return []
    same = Counter(d for d, _ in others)
    lines = Counter(p for _, ls in others for p, _ in ls)
    found = []
    for i, (digest, own) in enumerate(sections):
        if same[digest]:
            same[digest] -= 1
            lines.subtract(p for p, _ in own)
            continue
        for k, (paragraph, _) in enumerate(own):
            if lines[paragraph] > 0:
                lines[paragraph] -= 1
            else:
                found.append((i, k))
    return found


def add_fingerprint(documents: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """All columns with the fingerprint of the text; a clashing column is replaced."""
    kept = [c for c in documents.columns if c != name]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        for batch, texts in text_slices(batches, "_text"):
            trees = pa.array([fingerprint(t) for t in texts.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(kept))], trees], names=[*kept, name]
            )

    return source.mapInArrow(run, source.drop("_text").schema.add(name, "string"))


def _halves(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class _Document:
    """A text with its tree, and its lines for texts that share them."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text, self.lines = doc_id, text, {}
        self.tree = fingerprint(text, self.lines)
        self.pieces = pieces(self.tree)

    def compared(self, following: _Document) -> dict:
        edited = _halves(self.text, following.text)
        tree = fingerprint(edited, {**following.lines, **self.lines})
        return {
            "doc_id": self.doc_id,
            "n_chars": len(self.text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": self.tree,
            "edited_fingerprint": tree,
            "near_edited": likeness_of(self.pieces, pieces(tree)),
            "near_next": likeness_of(self.pieces, following.pieces),
        }


def _in_ranges(schema: pa.Schema):
    """Compares the documents of sorted ranges, the last of each with the copy that ends it."""

    def run(batches):
        held, range_no = None, None
        for batch in batches:
            for piece, texts in text_slices([batch], "text"):
                rows = []
                for number, copy, doc_id, text in zip(
                    *(piece.column(i).to_pylist() for i in range(3)), texts.to_pylist(), strict=True
                ):
                    if number != range_no:
                        held, range_no = None, number
                    if copy and held is None:  # a further row with the id of the first copy
                        continue
                    new = _Document(doc_id, text)
                    if held is not None:
                        rows.append(held.compared(new))
                    held = None if copy else new
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


#: Rows of a range on average, and the most ranges that ids are cut into.
RANGE_ROWS, MAX_RANGES = 2_000, 16_384


def _longs(values: list, kind: str = "array<bigint>") -> Column:
    """A constant array, as one literal."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _range_of(doc_id: Column, borders: list[int]) -> Column:
    """How many of the falling borders lie above the id; found in two steps, by every so manieth
    border and then by those between two of them. Rows without an id come after all others."""
    step = max(1, math.isqrt(len(borders)))
    groups = [borders[i : i + step] for i in range(0, len(borders), step)]
    passed = F.size(F.filter(_longs([g[0] for g in groups]), lambda b: b > doc_id))
    inside = F.get(_longs(groups, "array<array<bigint>>"), passed - 1)
    found = F.when(passed == 0, F.lit(0)).otherwise(
        (passed - 1) * step + F.size(F.filter(inside, lambda b: b > doc_id))
    )
    return F.when(doc_id.isNull(), F.lit(len(borders) + 1)).otherwise(found)


def compare_with_next(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and likenesses.

    The next document is the one with the next smaller id; after the last comes the first.  Ids are
    cut into ranges of about equal numbers of rows, and every text is sent once, to the task of its
    range.  The first document of a range also goes to the range before, as what follows its last.
    The driver learns a border and a first id per range, not more.

    Rows with equal ids follow each other by text; rows without an id come last; a table of one row
    is followed by itself.
    """
    source = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    ids = source.select("doc_id").filter("doc_id IS NOT NULL")
    parts = min(MAX_RANGES, -(-ids.count() // range_rows))
    borders = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        found = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts))).first()[0]
        borders = sorted(set(found), reverse=True)
    number = _range_of(F.col("doc_id"), borders) if borders else F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    number = number.cast("int")
    firsts = source.select(number.alias("range"), "doc_id").groupBy("range").agg(F.max("doc_id").alias("first"))
    firsts = sorted((r.range, r.first) for r in firsts.collect())
    # By range: its first id, and the range that this id also goes to.
    first_id, before = [None] * (len(borders) + 2), [-1] * (len(borders) + 2)
    for at, (range_no, doc_id) in enumerate(firsts):
        first_id[range_no], before[range_no] = doc_id, firsts[at - 1][0]
    own = F.struct(F.col("range"), F.lit(False).alias("copy"))
    copy = F.struct(F.get(_longs(before), F.col("range")).cast("int").alias("range"), F.lit(True).alias("copy"))
    is_first = F.get(_longs(first_id), F.col("range")).eqNullSafe(F.col("doc_id"))
    dealt = (
        source.withColumn("range", number)
        .select(F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))).alias("to"), "doc_id", "text")
        .select("to.range", "to.copy", "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "copy", F.desc("doc_id"), "text")
    )
    result = T.StructType.fromDDL(_RESULT)
    return dealt.mapInArrow(_in_ranges(to_arrow_schema(result)), result)
