"""Brown class-based n-gram model, learned from a corpus and used to score documents.

The probability of a word after another is that of its class after the other's class, times that
of the word in its class.  Exchange clustering assigns classes, in two steps.  First the most
frequent words, and one item for all other words that end alike, are exchanged one by one: each
moves to the class that raises the likelihood of the training text most, until few move.  Then
every other word of the training set, whatever its frequency, is exchanged by its own neighbours,
in Spark, all against the same table of classes; a word that no class suits clearly better keeps that
of its ending.  Words never seen in training take the class of their ending as well, with a part of
that class kept for them; all probabilities sum to one.

What is learned covers the whole training set: counts of every word, the neighbours' classes of
every word, transitions between the final classes.  The driver gets tables of bounded size only:
``head`` words with counts and classes, pair counts of at most (words + endings + 1) squared cells,
and classes squared.  Counts and classes of rarer words stay distributed, and are joined to the
rare words of the documents.

``learn_and_score`` does both for documents that include the training set: tokens of rare words are
shuffled once by word, where the word's class is found from all its neighbours, and once back to
their texts, and every text is then a path of classes.  ``learn`` and ``score`` serve a model apart from
the documents.

Defined cases: a null or blank text is the end token alone; without training text every count is
0 and all scores follow from the smoothing; rows that repeat are scored each by itself; an empty
table gives an empty result; other columns stay, and clashing result columns replace them.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vecspark.llm.batches import spans, text_slices, word_codes
from vecspark.sources.workspace import materialize

#: Words that are exchanged one by one.
ITEM_WORDS = 768
#: Items that stand for all other words at first, by their last bytes.
ENDINGS = 128
ENDING_BYTES = 3
CLASSES = 64
SWEEPS = 12
#: What naming a class costs, in units of log likelihood.
MOVE_COST = float(np.log(CLASSES))
#: Words whose counts all tasks hold, and the longest such word in bytes.
HEAD_WORDS = 50_000
MAX_HEAD_BYTES = 64
#: Added to every count of a word; weight of the class frequencies in the transitions.
ADDED, TRANSITION_PRIOR = 0.5, 30.0
#: Text that is worked on at a time; each byte takes some fifty while it is.
TEXT_BYTES = 4 << 20
#: Steps of word frequency per doubling, by which the head is cut off.
_STEPS = 8


def ending_of(word: str) -> int:
    return zlib.crc32(word.encode()[-ENDING_BYTES:]) % ENDINGS


@dataclass
class Items:
    """Which item a word belongs to. The end token is the last item."""

    head: dict[str, int]
    words: int

    @property
    def end(self) -> int:
        return self.words + ENDINGS

    def numbers(self, words: list[str]) -> np.ndarray:
        """Places in the head, -1 for other words."""
        get = self.head.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def of(self, words: list[str]) -> np.ndarray:
        found = self.numbers(words)
        rest = np.flatnonzero((found < 0) | (found >= self.words))
        found[rest] = [self.words + ending_of(words[i]) for i in rest.tolist()]
        return found


def count_words(training: DataFrame) -> DataFrame:
    """``word`` and ``n`` over the column ``text``."""

    def run(batches):
        for _, texts in text_slices(batches, "text", TEXT_BYTES):
            _, codes, words = word_codes(pc.ascii_lower(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.string()),
                    pa.array(np.bincount(codes, minlength=len(words)), pa.int64()),
                ],
                names=["word", "n"],
            )

    parts = training.mapInArrow(run, "word string, n long").filter("word <> ''")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _in_head(least: int) -> Column:
    return (F.octet_length("word") <= MAX_HEAD_BYTES) & (F.floor(F.log2("n") * _STEPS) >= least)


def head_of(counts: DataFrame, limit: int = HEAD_WORDS) -> tuple[list[tuple[str, int]], int | None]:
    """The most frequent words, ``limit`` at most, down to a frequency step that fits whole, and
    that step."""
    eligible = counts.filter(F.octet_length("word") <= MAX_HEAD_BYTES)
    step = F.floor(F.log2("n") * _STEPS)
    sizes = eligible.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    held, least = 0, None
    for row in sorted(sizes, key=lambda r: -r.step):
        held += row.words
        if held > limit:
            break
        least = row.step
    if least is None:
        return [], None
    found = counts.filter(_in_head(least)).select("word", "n").collect()
    return sorted(((r.word, r.n) for r in found), key=lambda x: (-x[1], x[0])), least


def _inner(per_text: np.ndarray) -> np.ndarray:
    """Where words stand in flat sequences with an end token before and after each text."""
    inner = np.ones(int((per_text + 2).sum()), bool)
    start, stop = spans(per_text + 2)
    inner[start] = inner[stop - 1] = False
    return np.flatnonzero(inner)


def item_sequences(texts: pa.Array, items: Items):
    """Per text the items of its tokens after an end token, flat, with the words they came from."""
    per_text, codes, words = word_codes(pc.ascii_lower(texts))
    of_word = items.of(words)
    flat = np.full(int((per_text + 2).sum()), items.end, np.int64)
    flat[_inner(per_text)] = of_word[codes]
    return per_text, codes, words, flat


def count_pairs(training: DataFrame, items: Items) -> np.ndarray:
    """How often each item follows each item, over the column ``text``."""
    size = items.end + 1

    def run(batches):
        pairs = np.zeros(size * size, np.int64)
        for _, texts in text_slices(batches, "text", TEXT_BYTES):
            per_text, _, _, flat = item_sequences(texts, items)
            within = np.ones(len(flat), bool)
            within[spans(per_text + 2)[1] - 1] = False
            at = np.flatnonzero(within)
            pairs += np.bincount(flat[at] * size + flat[at + 1], minlength=size * size)
        cells = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(pairs[cells])], names=["cell", "n"]
        )

    summed = training.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = summed.toArrow()  # no more rows than cells
    pairs = np.zeros(size * size, np.int64)
    pairs[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return pairs.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_clusters(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of every item. The last item, the end, has the last class to itself."""
    size = len(pairs)
    pairs = pairs.astype(np.float64)
    total = pairs.sum(axis=0)
    open_classes = max(classes - 1, 1)
    order = np.argsort(-total[:-1], kind="stable")
    assigned = np.empty(size, np.int64)
    assigned[order] = np.arange(size - 1) % open_classes
    assigned[-1] = classes - 1
    member = np.zeros((size, classes))
    member[np.arange(size), assigned] = 1
    after, before = pairs @ member, pairs.T @ member  # item followed by class, preceded by class
    table = member.T @ after
    left, right = table.sum(axis=1), table.sum(axis=0)
    for _ in range(sweeps):
        moved = 0
        for item in order.tolist():
            own, old = pairs[item, item], assigned[item]
            follow, precede = after[item].copy(), before[item].copy()
            follow[old] -= own
            precede[old] -= own
            out, into = follow.sum() + own, precede.sum() + own
            table[old] -= follow
            table[:, old] -= precede
            table[old, old] -= own
            left[old] -= out
            right[old] -= into
            rows = _xlogx(table + follow) - _xlogx(table)
            columns = _xlogx(table + precede[:, None]) - _xlogx(table)
            corner = np.diag(table)
            gain = (
                rows.sum(axis=1) - np.diag(rows) + columns.sum(axis=0) - np.diag(columns)
                + _xlogx(corner + follow + precede + own) - _xlogx(corner)
                - _xlogx(left + out) + _xlogx(left) - _xlogx(right + into) + _xlogx(right)
            )
            gain[open_classes:] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += follow
            table[:, new] += precede
            table[new, new] += own
            left[new] += out
            right[new] += into
            if new != old:
                moved += 1
                assigned[item] = new
                for counts, column in ((after, pairs[:, item]), (before, pairs[item])):
                    counts[:, old] -= column
                    counts[:, new] += column
        if moved <= size // 500:
            break
    return assigned


def count_neighbours(training: DataFrame, items: Items, item_class: np.ndarray) -> DataFrame:
    """``word``, ``cells``, ``ns``: how often which classes stand around every word without an
    item of its own.

    A cell under classes squared is a pair of left and right class.  Words of the head are summed
    in their task; for them, further cells count left and right classes apart.
    """
    names = list(items.head)
    square = CLASSES * CLASSES

    def rows(words, number, cell, n):
        """One row per word; equal numbers stand together."""
        first = np.flatnonzero(np.diff(number, prepend=-1))
        offsets = pa.array(np.append(first, len(number)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in number[first].tolist()], pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(cell, pa.int16())),
                pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32())),
            ],
            names=["word", "cells", "ns"],
        )

    def run(batches):
        held = np.zeros(len(names) * 2 * CLASSES, np.int64)
        for _, texts in text_slices(batches, "text", TEXT_BYTES):
            per_text, codes, words, flat = item_sequences(texts, items)
            classes = item_class[flat]
            at = _inner(per_text)
            number = items.numbers(words)[codes]
            left, right = classes[at - 1], classes[at + 1]
            of_head = np.flatnonzero(number >= items.words)
            for side, shift in ((left, 0), (right, CLASSES)):
                cells, n = np.unique(number[of_head] * (2 * CLASSES) + side[of_head] + shift, return_counts=True)
                held[cells] += n
            rare = np.flatnonzero(number < 0)
            cells, n = np.unique(codes[rare] * square + left[rare] * CLASSES + right[rare], return_counts=True)
            code, cell = np.divmod(cells, square)
            yield rows(words, code, cell, n)
        cells = np.flatnonzero(held)
        number, cell = np.divmod(cells, 2 * CLASSES)
        yield rows(names, number, square + cell, held[cells])

    return training.mapInArrow(run, "word string, cells array<smallint>, ns array<int>")


def best_classes(
    follow: np.ndarray, precede: np.ndarray, old: np.ndarray, table: np.ndarray
) -> np.ndarray:
    """The class that each word moves to, against one table of classes that no move changes.

    Rows of ``follow`` and ``precede`` count the classes after and before a word.  A class is
    judged by the likelihood that its other words, smoothed as in the model, give to the word's
    neighbours and to the word as one of them; its own counts are left out of its class, or else
    rare words would be learned by heart.  It leaves its class only for a likelihood so much
    greater that it pays for naming the new one.
    """
    words, classes = follow.shape
    rows, n = np.arange(words), precede.sum(axis=1)
    left, held = table.sum(axis=1), table.sum(axis=0)
    share = (held + 1) / (held + 1).sum()

    def step(cells, before, new):
        """log of a class after a class, but for what only depends on the class before."""
        return np.log(cells + TRANSITION_PRIOR * share[new]) - np.log(before + TRANSITION_PRIOR)

    every = np.arange(classes)
    steps = step(table, left[:, None], every[None, :])
    gain = follow @ steps.T + precede @ steps - n[:, None] * np.log(held + n[:, None] + ADDED)
    # The own class, without the word.
    own = -n * np.log(held[old] + ADDED)
    word, c = np.nonzero(follow)
    x, k = follow[word, c], old[word]
    own += np.bincount(word, x * step(np.maximum(table[k, c] - x, 0), left[k] - n[word], c), words)
    word, c = np.nonzero(precede)
    x, k = precede[word, c], old[word]
    own += np.bincount(word, x * step(np.maximum(table[c, k] - x, 0), left[c], k), words)
    gain[rows, old] = own
    gain[:, -1] = -np.inf  # the end's class
    new = gain.argmax(axis=1)
    return np.where(gain[rows, new] > gain[rows, old] + MOVE_COST, new, old)


def exchange_words(neighbours: DataFrame, ending_class: np.ndarray, table: np.ndarray) -> DataFrame:
    """``word``, ``n`` and ``class`` of every word whose neighbours were counted."""
    square = CLASSES * CLASSES

    def run(batches):
        for batch in batches:
            lists, words = batch.column("cells"), batch.column("word").to_pylist()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            cells = lists.flatten()
            cell, n = (cells.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            of_word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
            old = ending_class[[ending_of(w) for w in words]]
            found, counts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
            # As many words at a time as have some thousand cells.
            group = ends // 4_096
            for first in np.flatnonzero(np.diff(group, prepend=-1)).tolist():
                last = int(np.searchsorted(group, group[first], "right"))
                begin, end = int(ends[first - 1]) if first else 0, int(ends[last - 1])
                at, c, m = of_word[begin:end] - first, cell[begin:end], n[begin:end]
                left = np.where(c < square, c // CLASSES, c - square)
                right = np.where(c < square, c % CLASSES, c - square - CLASSES)
                has_left, has_right = left < CLASSES, right >= 0
                shape = (last - first, CLASSES)
                precede, follow = (
                    np.bincount(at[has] * CLASSES + side[has], m[has], shape[0] * CLASSES).reshape(shape)
                    for has, side in ((has_left, left), (has_right, right))
                )
                found[first:last] = best_classes(follow, precede, old[first:last], table)
                counts[first:last] = precede.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(counts), pa.array(found, pa.int32())], names=["word", "n", "class"]
            )

    # A word has a row per task or slice at most, so all of them may meet in one partition.
    met = neighbours.repartition("word").select("word", F.explode(F.arrays_zip("cells", "ns")).alias("at"))
    met = met.select("word", F.col("at.cells").cast("int").alias("cell"), F.col("at.ns").alias("n"))
    summed = met.groupBy("word", "cell").agg(F.sum("n").alias("n"))
    listed = summed.groupBy("word").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
    return listed.mapInArrow(run, "word string, n long, class int")


class _Known:
    """Classes in a slice of texts: those of head words, and what is known about the others."""

    def __init__(self, texts: pa.Array, items: Items, head_class: np.ndarray, ending_class: np.ndarray):
        self.per_text, self.codes, self.words = word_codes(pc.ascii_lower(texts))
        number = items.numbers(self.words)
        self.number = number
        self.at = _inner(self.per_text)
        self.classes = np.full(int((self.per_text + 2).sum()), CLASSES - 1, np.int64)
        self.classes[self.at] = np.append(head_class, -1)[number[self.codes]]
        #: Tokens without a known class, by their place among the words of the slice.
        self.rare = np.flatnonzero(number[self.codes] < 0)
        text = np.repeat(np.arange(len(self.per_text)), self.per_text)
        self.text = text
        place, code = self.at[self.rare], self.codes[self.rare]
        fallback = np.full(len(self.words), -1, np.int64)
        for c in np.unique(code).tolist():
            fallback[c] = ending_class[ending_of(self.words[c])]
        self.columns = [
            pa.array(self.words, pa.string()).take(pa.array(code)), pa.array(place, pa.int64()),
            pa.array(self.classes[place - 1], pa.int32()), pa.array(self.classes[place + 1], pa.int32()),
            pa.array(fallback[code], pa.int32()),
        ]

    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and cell of every token whose class and whose predecessor's are known."""
        tokens = self.per_text + 1
        later = np.ones(len(self.classes), bool)
        later[spans(self.per_text + 2)[0]] = False
        at = np.flatnonzero(later)
        text = np.repeat(np.arange(len(tokens)), tokens)
        both = (self.classes[at - 1] >= 0) & (self.classes[at] >= 0)
        at = at[both]
        return text[both], self.classes[at - 1] * CLASSES + self.classes[at]


_RARE = "word string, at long, before int, after int, fallback int"


def with_classes(rare: DataFrame, classes: DataFrame) -> DataFrame:
    """Rare tokens with ``class`` and ``n`` of the word, and the class ``before`` each, also where
    the token before it is rare."""
    joined = rare.join(classes, "word", "left")
    joined = joined.withColumn("class", F.coalesce("class", "fallback"))
    previous = F.lag("class").over(Window.partitionBy("_row").orderBy("at"))
    return joined.withColumn("before", F.when(F.col("before") >= 0, F.col("before")).otherwise(previous))


def count_transitions(
    training: DataFrame, items: Items, head_class: np.ndarray, ending_class: np.ndarray, classes: DataFrame
) -> np.ndarray:
    """How often each class follows each class, over the column ``text``."""
    square = CLASSES * CLASSES
    fields = ["_row", "word", "at", "before", "after", "fallback", "tokens"]

    def run(batches):
        first = TaskContext.get().partitionId() << 40
        row, known = first, np.zeros(square, np.int64)
        for _, texts in text_slices(batches, "text", TEXT_BYTES):
            found = _Known(texts, items, head_class, ending_class)
            known += np.bincount(found.steps()[1], minlength=square)
            ones = pa.array(np.ones(len(found.rare), np.int64))
            rows = pa.array(row + found.text[found.rare])
            yield pa.RecordBatch.from_arrays([rows, *found.columns, ones], names=fields)
            row += len(found.per_text)
        # What the task knows itself, as rows of words that no text has, each a row number of its own.
        cells = np.flatnonzero(known)
        none = pa.array(np.full(len(cells), -1), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(-1 - first - cells), pa.array([f" {c}" for c in cells.tolist()], pa.string()),
                pa.array(np.zeros(len(cells), np.int64)), pa.array(cells // CLASSES, pa.int32()),
                pa.array(cells % CLASSES, pa.int32()), none, pa.array(known[cells]),
            ],
            names=fields,
        )

    rare = training.mapInArrow(run, f"_row long, {_RARE}, tokens long")
    around = with_classes(rare, classes.select("word", "class"))
    around = around.groupBy("before", "class", "after").agg(F.sum("tokens").alias("n"))
    own, before, after = F.col("class"), F.col("before") * CLASSES, F.col("after")
    steps = F.when(own < 0, F.array(before + after)).when(after < 0, F.array(before + own)).otherwise(
        F.array(before + own, own * CLASSES + after)
    )
    summed = around.select(F.explode(steps).alias("cell"), "n").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(square)
    for r in summed.collect():  # no more rows than cells
        table[r["cell"]] = r["n"]
    return table.reshape(CLASSES, CLASSES)


@dataclass
class ClassModel:
    """What a task needs to score documents but for the counts and classes of rare words."""

    items: Items
    counts: np.ndarray  # of head words, by number
    head_class: np.ndarray
    ending_class: np.ndarray
    ends: int
    train_tokens: int
    vocabulary: int
    transition: np.ndarray  # of a class after a class
    mass: np.ndarray  # smoothed count of all words of a class

    @property
    def step(self) -> np.ndarray:
        """log10 of a class after a class, by the smoothed count of the new one."""
        with np.errstate(divide="ignore"):
            found = np.log10(self.transition) - np.log10(self.mass)
        return np.where(self.mass > 0, found, 0.0)


def _model(items, head, head_class, ending_class, ends, totals, table, mass) -> ClassModel:
    """``totals`` are the distinct words and the words of the training set."""
    frequency = np.where(mass > 0, table.sum(axis=0) + 1, 0)
    frequency /= frequency.sum()
    transition = (table + TRANSITION_PRIOR * frequency) / (
        table.sum(axis=1, keepdims=True) + TRANSITION_PRIOR
    )
    return ClassModel(
        items,
        np.array([n for _, n in head], np.int64),
        head_class,
        ending_class,
        ends,
        int(totals[1]) + ends,
        int(totals[0]) + (ends > 0),
        transition,
        mass,
    )


def learn(training: DataFrame, head_words: int = HEAD_WORDS) -> tuple[ClassModel, DataFrame]:
    """The model, and counts and classes of all words (``word``, ``n``, ``class``)."""
    training = training.select("text")
    counts = materialize(count_words(training), "words")
    head, least = head_of(counts, head_words)
    items = Items({w: i for i, (w, _) in enumerate(head)}, min(ITEM_WORDS, len(head)))
    pairs = count_pairs(training, items)
    totals = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = int(pairs[items.end].sum())
    item_class = exchange_clusters(pairs)
    member = np.eye(CLASSES)[item_class]
    ending_class = item_class[items.words : items.end]
    neighbours = count_neighbours(training, items, item_class)
    moved = materialize(exchange_words(neighbours, ending_class, member.T @ pairs @ member), "classes")
    head_class = np.empty(len(head), np.int64)
    head_class[: items.words] = item_class[: items.words]
    if least is not None:
        for row in moved.filter(_in_head(least)).collect():  # head words but the items
            head_class[items.head[row["word"]]] = row["class"]
    mass = ADDED * np.bincount(ending_class, minlength=CLASSES)
    mass[-1] += ends + ADDED
    for (_, n), c in zip(head[: items.words], head_class, strict=False):
        mass[c] += n + ADDED
    for row in moved.groupBy("class").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect():
        mass[row["class"]] += row["n"] + ADDED * row["words"]
    table = count_transitions(training, items, head_class, ending_class, moved)
    model = _model(items, head, head_class, ending_class, ends, totals, table, mass)
    own = [(w, n, int(c)) for (w, n), c in zip(head[: items.words], head_class, strict=False)]
    frequent = training.sparkSession.createDataFrame(own, moved.schema)
    return model, moved.unionByName(frequent)


def score(documents: DataFrame, model: ClassModel, counts: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents without their texts, with ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``."""
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in documents.columns if c != text_col and c not in results]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"))
    schema = source.drop("_text").schema
    token = T.StructType.fromDDL(_RARE)
    for name, kind in (
        ("_row", "long"), ("_tokens", "long"), ("_known", "long"), ("_words", "double"), ("_steps", "double"),
        ("_rare", T.ArrayType(token)),
    ):
        schema = schema.add(name, kind)
    items, steps = model.items, model.step
    per_token = float(np.log10(model.train_tokens + ADDED * (model.vocabulary + 1)))
    end_log, end_known = float(np.log10(model.ends + ADDED)), int(model.ends > 0)

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        log_count = np.append(np.log10(model.counts + ADDED), 0.0)
        for batch, texts in text_slices(batches, "_text", TEXT_BYTES):
            found = _Known(texts, items, model.head_class, model.ending_class)
            size = len(found.per_text)
            number = found.number[found.codes]
            of_words = np.bincount(found.text, log_count[number], size) + end_log
            known = np.bincount(found.text, number >= 0, size).astype(np.int64) + end_known
            text, cell = found.steps()
            of_steps = np.bincount(text, steps.ravel()[cell], size)
            offsets = np.searchsorted(found.text[found.rare], np.arange(size + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(found.columns, token.names)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array(row + np.arange(size)), pa.array(found.per_text + 1), pa.array(known),
                    pa.array(of_words, pa.float64()), pa.array(of_steps, pa.float64()), lists,
                ],
                names=[f.name for f in schema],
            )
            row += size

    scored = materialize(source.mapInArrow(run, schema), "scored")
    rare = with_classes(scored.select("_row", F.inline("_rare")), counts)
    n = F.coalesce("n", F.lit(0))
    table = F.from_json(F.lit(json.dumps(steps.ravel().tolist())), "array<double>")
    own, after = F.col("class"), F.col("after")
    step = F.get(table, F.col("before") * CLASSES + own) + F.when(
        after >= 0, F.get(table, own * CLASSES + after)
    ).otherwise(0.0)
    rest = rare.groupBy("_row").agg(
        F.sum(F.log10(n + ADDED)).alias("_more_words"),
        F.sum(step).alias("_more_steps"),
        F.sum((n > 0).cast("long")).alias("_more"),
    )
    words = F.col("_words") + F.coalesce("_more_words", F.lit(0.0))
    return scored.drop("_rare").join(rest, "_row", "left").select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("_tokens").alias("n_tokens"),
        (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (words - F.col("_tokens") * per_token).alias("base_score"),
        (words + F.col("_steps") + F.coalesce("_more_steps", F.lit(0.0))).alias("score"),
    )


#: A token of a rare word: its place among the words of its slice, and the cell of the classes around it.
_TOKEN = np.dtype([("at", "<u4"), ("cell", "<u2")])
#: The same with class and count of the word.
_CLASSED = np.dtype([("at", "<u4"), ("class", "u1"), ("n", "<i8")])
#: Cell of tokens that nothing is learned from.
_UNLEARNED = CLASSES * CLASSES
#: Rows of rare words that are worked on at a time, and words whose classes are compared at a time.
_WORD_ROWS, _WORDS = 1 << 16, 4_096
#: Classes of words that are worked on at a time, a byte each.
_PATH_BYTES = 1 << 20


def _packed(values: np.ndarray, first: np.ndarray) -> pa.BinaryArray:
    """Runs of packed values, each from its place in ``first`` to the next, as binary values."""
    offsets = (np.append(first, len(values)) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Packed values one after another, and how many each binary value has."""
    size = pc.binary_length(column).to_numpy(zero_copy_only=False) if len(column) else np.empty(0, np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), kind), size.astype(np.int64) // np.dtype(kind).itemsize


def mark_tokens(source: DataFrame, items: Items, item_class: np.ndarray) -> DataFrame:
    """Rows of two kinds, from one pass over the column ``_text``; ``_trained`` says what is learned from.

    A text keeps its other columns and has ``_numbers``, the places of its words in the head (the head's
    length: not in it), and ``_first``, the place of its first word in its ``_slice``.  A word has the
    ``_slice`` where it stands and ``_at``, its tokens there.  Words of the head are summed in their task: they
    have ``-1 - place`` for a slice, and ``_at`` counts the classes left and right of them.
    """
    kept = source.drop("_text").schema.fields
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept])
    for name, kind in (
        ("_slice", "long"), ("_first", "long"), ("_numbers", "binary"), ("_word", "string"), ("_at", "binary")
    ):
        schema = schema.add(name, kind)
    names = list(items.head)
    place = np.min_scalar_type(len(names))

    def words_of(types, numbers, words, packed):
        none = [pa.nulls(len(words), t) for t in types]
        columns = [*none, pa.array(numbers, pa.int64()), pa.nulls(len(words), pa.int64()), pa.nulls(len(words), pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.string()), packed], names=schema.fieldNames())

    def run(batches):
        held, types = np.zeros(len(names) * 2 * CLASSES, np.int64), None
        slice_number = TaskContext.get().partitionId() << 32
        for batch, texts in text_slices(batches, "_text", TEXT_BYTES):
            own = [batch.column(f.name) for f in kept]
            types = [c.type for c in own]
            per_text, codes, words, flat = item_sequences(texts, items)
            number = items.numbers(words)[codes]
            trained = np.repeat(batch.column("_trained").to_numpy(zero_copy_only=False).astype(bool), per_text)
            classes, at = item_class[flat], _inner(per_text)
            left, right = classes[at - 1], classes[at + 1]
            of_head = np.flatnonzero((number >= items.words) & trained)
            for side, shift in ((left, 0), (right, CLASSES)):
                cells, n = np.unique(number[of_head] * (2 * CLASSES) + side[of_head] + shift, return_counts=True)
                held[cells] += n
            rare = np.flatnonzero(number < 0)
            rare = rare[np.argsort(codes[rare], kind="stable")]
            code = codes[rare]
            tokens = np.empty(len(rare), _TOKEN)
            tokens["at"] = rare
            tokens["cell"] = np.where(trained[rare], left[rare] * CLASSES + right[rare], _UNLEARNED)
            first = np.flatnonzero(np.diff(code, prepend=-1))
            numbers = np.where(number < 0, len(names), number).astype(place)
            begin, size = spans(per_text)[0], len(per_text)
            yield pa.RecordBatch.from_arrays(
                [
                    *own, pa.array(np.full(size, slice_number)), pa.array(begin), _packed(numbers, begin),
                    pa.nulls(size, pa.string()), pa.nulls(size, pa.binary()),
                ],
                names=schema.fieldNames(),
            )
            yield words_of(types, np.full(len(first), slice_number), [words[i] for i in code[first].tolist()], _packed(tokens, first))
            slice_number += 1
        cells = np.flatnonzero(held)
        if len(cells):
            number, cell = np.divmod(cells, 2 * CLASSES)
            sums = np.empty(len(cells), _TOKEN)
            sums["at"], sums["cell"] = held[cells], cell
            first = np.flatnonzero(np.diff(number, prepend=-1))
            yield words_of(types, -1 - number[first], [names[i] for i in number[first].tolist()], _packed(sums, first))

    return source.mapInArrow(run, schema)


def class_tokens(marked: DataFrame, ending_class: np.ndarray, table: np.ndarray) -> DataFrame:
    """Rows of three kinds, once all tokens of a word have met: ``_slice`` and ``_classed``, tokens with class and
    count of their words; ``_slice`` under 0 and ``class`` of a word of the head; and ``class`` with the number of
    ``words`` seen in training and their counts ``n``."""
    names = ["_slice", "_classed", "class", "words", "n"]

    def classes_of(rows: pa.Table):
        """Tokens, their slices, and number, count and class of each word."""
        words = rows.column("_word").combine_chunks()
        entry, size = _unpacked(rows.column("_at"), _TOKEN)
        new = np.ones(len(words), bool)
        new[1:] = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        number = rows.column("_slice").to_numpy()
        word, of_slice = np.repeat(np.cumsum(new) - 1, size), np.repeat(number, size)
        cell, of_head = entry["cell"].astype(np.int64), of_slice < 0
        weight = np.where(of_head, entry["at"], cell < _UNLEARNED).astype(np.float64)
        sides = (
            (np.where(of_head, cell, cell // CLASSES), weight * (~of_head | (cell < CLASSES))),
            (np.where(of_head, cell - CLASSES, cell % CLASSES), weight * (~of_head | (cell >= CLASSES))),
        )
        old = ending_class[[ending_of(w) for w in words.take(pa.array(first)).to_pylist()]]
        found, n = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        for start in range(0, len(first), _WORDS):
            stop = min(start + _WORDS, len(first))
            begin, end = np.searchsorted(word, (start, stop))
            shape = (stop - start, CLASSES)
            counts = []
            for side, w in sides:
                used = begin + np.flatnonzero(w[begin:end])
                at = (word[used] - start) * CLASSES + side[used]
                counts.append(np.bincount(at, w[used], shape[0] * CLASSES).reshape(shape))
            found[start:stop] = best_classes(counts[1], counts[0], old[start:stop], table)
            n[start:stop] = counts[0].sum(axis=1)
        return entry["at"], word, of_slice, number[first], n, found

    def run(batches):
        sums = np.zeros((2, CLASSES), np.int64)

        def found(rows: pa.Table):
            place, word, of_slice, number, n, classes = classes_of(rows)
            seen = n > 0
            sums[0] += np.bincount(classes[seen], minlength=CLASSES)
            sums[1] += np.bincount(classes, n, CLASSES).astype(np.int64)
            head = np.flatnonzero(number < 0)
            none = [pa.nulls(len(head), t) for t in (pa.binary(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[head]), none[0], pa.array(classes[head], pa.int32()), *none[1:]], names=names
            )
            rare = np.flatnonzero(of_slice >= 0)
            rare = rare[np.argsort(of_slice[rare], kind="stable")]
            tokens = np.empty(len(rare), _CLASSED)
            tokens["at"], tokens["class"], tokens["n"] = place[rare], classes[word[rare]], n[word[rare]]
            first = np.flatnonzero(np.diff(of_slice[rare], prepend=-1))
            none = [pa.nulls(len(first), t) for t in (pa.int32(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(of_slice[rare][first]), _packed(tokens, first), *none], names=names)

        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows < _WORD_ROWS:
                continue
            together = pa.Table.from_batches(waiting)
            words = together.column("_word").combine_chunks()
            # The last word may go on in the next batch.
            whole = pc.index(words, words[-1]).as_py()
            if whole:
                yield from found(together.slice(0, whole))
            waiting, rows = together.slice(whole).to_batches(), 0
        if sum(b.num_rows for b in waiting):
            yield from found(pa.Table.from_batches(waiting))
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()), pa.array(used, pa.int32()),
                pa.array(sums[0][used]), pa.array(sums[1][used]),
            ],
            names=names,
        )

    # A word has a row per slice at most, so all of them may meet in one partition.
    words = marked.filter("_word IS NOT NULL").select("_word", "_slice", "_at")
    words = words.repartition("_word").sortWithinPartitions("_word")
    return words.mapInArrow(run, "_slice long, _classed binary, class int, words long, n long")


def class_paths(
    marked: DataFrame, classed: DataFrame, head_counts: np.ndarray, head_class: np.ndarray, ends: int
) -> DataFrame:
    """The texts with ``_path``, the class of each word in a byte, and ``_tokens``, ``_known`` and ``_words``, the sum of
    log10 of the smoothed counts."""
    texts = marked.filter("_numbers IS NOT NULL").drop("_word", "_at")
    schema = texts.drop("_slice", "_first", "_numbers").schema
    kept = schema.fieldNames()
    for name, kind in (("_tokens", "long"), ("_known", "long"), ("_words", "double"), ("_path", "binary")):
        schema = schema.add(name, kind)
    types = [to_arrow_type(f.dataType) for f in schema]
    place, end_log, end_known = np.min_scalar_type(len(head_class)), float(np.log10(ends + ADDED)), int(ends > 0)

    def run(texts: pa.Table, rare: pa.Table) -> pa.Table:
        texts = texts.sort_by("_first")
        number, size = _unpacked(texts.column("_numbers"), place)
        tokens, _ = _unpacked(rare.column("_classed"), _CLASSED)
        path = np.append(head_class, 0).astype(np.uint8)[number]
        count = np.append(head_counts, 0)[number]
        path[tokens["at"]], count[tokens["at"]] = tokens["class"], tokens["n"]
        text = np.repeat(np.arange(len(size)), size)
        known = np.bincount(text, count > 0, len(size)).astype(np.int64) + end_known
        of_words = np.bincount(text, np.log10(count + ADDED), len(size)) + end_log
        columns = [
            *[texts.column(c) for c in kept], pa.array(size + 1), pa.array(known), pa.array(of_words),
            _packed(path, spans(size)[0]),
        ]
        return pa.table([c.cast(t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames())

    rare = classed.filter("_slice >= 0").select("_slice", "_classed")
    return texts.groupBy("_slice").cogroup(rare.groupBy("_slice")).applyInArrow(run, schema)


def _path_steps(paths: pa.Array) -> tuple[int, np.ndarray, np.ndarray]:
    """How many texts there are, and text and cell of every token, the end included."""
    flat, size = _unpacked(paths.cast(pa.large_binary()), np.dtype(np.uint8))
    classes = np.full(int((size + 2).sum()), CLASSES - 1, np.int64)
    classes[_inner(size)] = flat
    later = np.ones(len(classes), bool)
    later[spans(size + 2)[0]] = False
    at = np.flatnonzero(later)
    return len(size), np.repeat(np.arange(len(size)), size + 1), classes[at - 1] * CLASSES + classes[at]


def path_transitions(paths: DataFrame) -> np.ndarray:
    """How often each class follows each class, over the column ``_path``."""
    square = CLASSES * CLASSES

    def run(batches):
        found = np.zeros(square, np.int64)
        for _, some in text_slices(batches, "_path", _PATH_BYTES):
            found += np.bincount(_path_steps(some)[2], minlength=square)
        cells = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(found[cells])], names=["cell", "n"])

    table = np.zeros(square)
    summed = paths.select("_path").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for r in summed.collect():  # no more rows than cells
        table[r["cell"]] = r["n"]
    return table.reshape(CLASSES, CLASSES)


def learn_and_score(
    documents: DataFrame, training: Column, text_col: str = "text", head_words: int = HEAD_WORDS
) -> DataFrame:
    """What ``score`` gives under the model that ``learn`` finds in the documents where ``training`` holds.

    Texts are read once for the tokens of both, and words are shuffled once.
    """
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in documents.columns if c != text_col and c not in results]
    source = documents.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"),
        F.coalesce(training, F.lit(False)).alias("_trained"),
    )
    learned = source.filter("_trained").select(F.col("_text").alias("text"))
    counts = materialize(count_words(learned), "words")
    head, _ = head_of(counts, head_words)
    items = Items({w: i for i, (w, _) in enumerate(head)}, min(ITEM_WORDS, len(head)))
    pairs = count_pairs(learned, items)
    totals = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = int(pairs[items.end].sum())
    item_class = exchange_clusters(pairs)
    member = np.eye(CLASSES)[item_class]
    ending_class = item_class[items.words : items.end]
    marked = materialize(mark_tokens(source, items, item_class), "marked")
    classed = materialize(class_tokens(marked, ending_class, member.T @ pairs @ member), "classed")
    head_class = np.empty(len(head), np.int64)
    head_class[: items.words] = item_class[: items.words]
    for row in classed.filter("_slice < 0").select("_slice", "class").collect():  # head words but the items
        head_class[-1 - row["_slice"]] = row["class"]
    mass = ADDED * np.bincount(ending_class, minlength=CLASSES)
    mass[-1] += ends + ADDED
    for (_, n), c in zip(head[: items.words], head_class, strict=False):
        mass[c] += n + ADDED
    sums = classed.filter("_slice IS NULL").groupBy("class").agg(F.sum("words").alias("words"), F.sum("n").alias("n"))
    for row in sums.collect():
        mass[row["class"]] += row["n"] + ADDED * row["words"]
    head_counts = np.array([n for _, n in head], np.int64)
    paths = materialize(class_paths(marked, classed, head_counts, head_class, ends), "paths")
    table = path_transitions(paths.filter("_trained"))
    model = _model(items, head, head_class, ending_class, ends, totals, table, mass)
    steps, train_tokens = model.step.ravel(), model.train_tokens
    per_token = float(np.log10(train_tokens + ADDED * (model.vocabulary + 1)))
    schema = documents.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in zip(results, ("long", "long", "long", "double", "double"), strict=True):
        schema = schema.add(name, kind)

    def run(batches):
        for batch, some in text_slices(batches, "_path", _PATH_BYTES):
            size, text, cell = _path_steps(some)
            tokens, words = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_tokens", "_words"))
            columns = [
                *[batch.column(i) for i in range(len(kept))], batch.column("_tokens"), batch.column("_known"),
                pa.array(np.full(size, train_tokens, np.int64)), pa.array(words - tokens * per_token),
                pa.array(words + np.bincount(text, steps[cell], size)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return paths.mapInArrow(run, schema)
