"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent 1- to 3-grams of letters in order.  Words are padded, so that
n-grams also tell where words begin and end.  A text is given the language whose profile is
nearest by out-of-place distance: the places by which the text's n-grams are off, and the length
of the profile for those that it lacks.

Profiles are counted over all training rows: tasks count their n-grams word by distinct word, and
Spark sums the counts and takes the top of each language.  Only the profiles, languages times
places, reach the driver and go out to the tasks; more languages than ``MAX_LANGUAGES`` raise an
error rather than a cut.

Defined cases: null texts and texts without letters are ``und`` with score 0; rows without a
language teach nothing; ties go to the n-gram of the lower code and the language of the lower
name; if nothing can be learned every text is ``und``; repeated rows count each; an empty table
gives an empty result; texts of any length are worked on in parts of ``PART_CHARS`` characters; other columns stay, and clashing result columns replace them.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecspark.llm.batches import ragged_take, text_slices, word_codes

#: Places of a profile, of a language as of a text.
PLACES = 400
#: Languages that the profiles may hold.
MAX_LANGUAGES = 4_000
#: Text whose words are counted together, and n-grams that a task sums up before it sends them on.
SLICE_BYTES, MAX_SUMS = 1 << 20, 1 << 20
#: Characters of a text whose n-grams are made at a time.
PART_CHARS = 1 << 18
UNDETERMINED = "und"

_EDGE = 1  # stands before and after a word
_BITS = np.uint64(21)


def letter_codes(text: str) -> np.ndarray:
    """Code points of a lower-case text; everything but letters is an edge."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known, which = np.unique(codes, return_inverse=True)
    letters = np.fromiter((chr(c).isalpha() for c in known.tolist()), bool, len(known))
    return np.where(letters, known, _EDGE)[which].astype(np.uint64)


def grams_of(codes: np.ndarray) -> list[np.ndarray]:
    """The n-grams that start at each place, for n = 1, 2, 3; 0 where there is none."""
    none, edges = np.uint64(0), np.full(2, _EDGE, np.uint64)
    second, third = np.append(codes, edges)[1:-1], np.append(codes, edges)[2:]
    inner = second != _EDGE
    one = np.where(codes != _EDGE, codes, none)
    two = np.where((codes != _EDGE) | inner, (codes << _BITS) | second, none)
    three = np.where(inner, (((codes << _BITS) | second) << _BITS) | third, none)
    return [one, two, three]


def ranked(grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, in order, and their counts."""
    if weights is None:
        return np.unique(grams, return_counts=True)
    order = np.argsort(grams, kind="stable")
    grams, weights = grams[order], weights[order]
    first = np.flatnonzero(np.diff(grams, prepend=~grams[:1]) != 0)
    return grams[first], np.add.reduceat(weights, first) if len(first) else weights


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts, by parts of ``PART_CHARS`` characters."""
    padded = f" {text.lower()} "
    found, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for start in range(0, len(padded), PART_CHARS):
        # Two more characters complete the n-grams that begin in the part.
        part = grams_of(letter_codes(padded[start : start + PART_CHARS + 2]))
        grams, n = ranked(np.concatenate([g[:PART_CHARS][g[:PART_CHARS] > 0] for g in part]))
        found, count = (grams, n) if not start else ranked(np.append(found, grams), np.append(count, n))
    return found, count


def count_grams(labelled: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and ``n`` of every task, from the columns ``lang`` and ``text``."""

    def emit(sums):
        for lang, (grams, count) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(count, pa.int64())],
                names=["lang", "gram", "n"],
            )

    def run(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch, texts in text_slices(batches, "text", SLICE_BYTES):
            per_text, codes, words = word_codes(texts)
            if not len(codes):
                continue
            # All words of the slice after one space each, and where each begins.
            lowered = [w.lower() for w in words]
            length = np.fromiter((len(w) + 1 for w in lowered), np.int64, len(words))
            grams = [g[: int(length.sum())] for g in grams_of(letter_codes(f" {' '.join(lowered)} "))]
            langs = batch.column(0).dictionary_encode()
            owner = np.repeat(langs.indices.to_numpy(zero_copy_only=False), per_text)
            order = np.argsort(owner, kind="stable")
            present, first = np.unique(owner[order], return_index=True)
            for number, mine in zip(present.tolist(), np.split(codes[order], first[1:]), strict=True):
                word, n = np.unique(mine, return_counts=True)
                at = ragged_take(np.arange(int(length.sum())), (np.cumsum(length) - length)[word], length[word])
                weight = np.repeat(n, length[word])
                parts = [(g[at], g[at] > 0) for g in grams]
                lang = langs.dictionary[number].as_py()
                known, count = sums.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                sums[lang] = ranked(
                    np.concatenate([known, *[g[ok] for g, ok in parts]]),
                    np.concatenate([count, *[weight[ok] for _, ok in parts]]),
                )
            if sum(len(g) for g, _ in sums.values()) > MAX_SUMS:
                yield from emit(sums)
                sums = {}
        yield from emit(sums)
        pa.default_memory_pool().release_unused()

    return labelled.mapInArrow(run, "lang string, gram long, n long")


def learn_profiles(
    documents: DataFrame, lang_col: str = "lang", text_col: str = "text", places: int = PLACES
) -> dict[str, list[int]]:
    """The n-grams of each language by place."""
    labelled = documents.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = count_grams(labelled).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Tasks rank their own n-grams of a language before those of all tasks are ranked.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).filter(F.col("place") <= places)
    profiles = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("grams"))
    found = profiles.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r.lang: [g.gram for g in r.grams] for r in sorted(found, key=lambda r: r.lang)}


class Profiles:
    """Profiles as one table: the place of every n-gram in every language."""

    def __init__(self, profiles: dict[str, list[int]], places: int):
        self.names, self.places = list(profiles), places
        self.grams = np.unique(np.array([g for grams in profiles.values() for g in grams], np.uint64))
        self.rank = np.full((len(self.grams) + 1, len(profiles)), -1, np.int32)
        for i, grams in enumerate(profiles.values()):
            self.rank[np.searchsorted(self.grams, np.array(grams, np.uint64)), i] = np.arange(len(grams))

    def nearest(self, text: str) -> tuple[str, float]:
        grams, count = gram_counts(text)
        # Of one letter are those without the bits of a second.
        if not self.names or not (grams < (np.uint64(1) << _BITS)).any():
            return UNDETERMINED, 0.0
        grams = grams[np.lexsort((grams, -count))[: self.places]]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        ranks = np.where((self.grams[at] == grams)[:, None], self.rank[at], -1)
        off = np.abs(ranks - np.arange(len(grams), dtype=np.int32)[:, None])
        distance = np.where(ranks < 0, self.places, off).sum(axis=0) / (self.places * len(grams))
        best = int(distance.argmin())
        return self.names[best], float(1 - distance[best])


def identify_language(
    documents: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", places: int = PLACES
) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, the nearness to the profile from 0 to 1."""
    added = {"lang_pred": "string", "score": "double"}
    kept = [c for c in documents.columns if c not in added]
    table = Profiles(profiles, places)

    def run(batches):
        for batch, texts in text_slices(batches, text_at, SLICE_BYTES):
            found = [table.nearest(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=[*kept, *added],
            )

    # The text goes out once, unless it is one of the columns that are replaced.
    text_at = text_col if text_col in kept else "_text"
    extra = [] if text_at == text_col else [F.col(f"`{text_col}`").alias("_text")]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], *extra)
    schema = documents.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return source.mapInArrow(run, schema)
