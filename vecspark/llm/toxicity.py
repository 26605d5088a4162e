"""Toxicity by a learned lexicon, misspellings by Levenshtein automata, and the words around a hit.

* **Lexicon.** Over all labelled texts Spark counts in how many toxic and other texts each word
  stands, and after how many different words it does so in toxic ones.  A word in many copies of
  one text follows few words, so it doesn't look like a term.  Beginnings that many such words
  share become stems, which stand for all words that begin so.
* **Misspellings.** A position of the product of the lexicon's trie with the Levenshtein automata
  is a node and the edits spent on the way to it.  Sets of positions are the states of one
  deterministic automaton.  It reads all distinct words of a slice at the same time, one character
  a step, and drops those that can't become a term any more.
* **Context.** A hit counts as a quotation if quotation marks enclose it within a window of words,
  or a word that reports speech precedes it.
* **Weights.** In how many toxic texts a term stands, by edits, by quotation or not, and once or
  more, gives its weight.  Rare combinations are drawn towards all terms with as many edits; quotations towards
  no evidence at all.  A score is the probability that follows from the weights of the terms in a
  text.

The lexicon is the only thing that goes out to the tasks: ``LEXICON_TERMS`` terms at most, the
strongest; counts cover all rows.

Defined cases: null texts are empty; texts without a term, empty ones too, get the share of toxic
texts among labelled ones without a term; without labels there are no terms and every score is
0.5; several labels of a document count as toxic if one is; null labels and labels of no document
teach nothing; rows that share an id are scored one by one; ties among terms go to fewer edits,
the longer term, then the alphabet; an empty table gives an empty result; texts of any length are
read whole, in slices of ``SLICE_BYTES`` where they are longer than the others; result columns
replace clashing ones, and other columns are not part of the result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from vecspark.llm.batches import record_batch, spans, text_slices, word_codes

#: Terms of the lexicon, the strongest first.
LEXICON_TERMS = 500
#: Toxic texts that a term is in, and classes (of 64) of words that it follows there.
MIN_TEXTS = MIN_FOLLOWED = 6
#: Different words that begin with a stem.
MIN_STEM_WORDS = 3
#: Share of toxic texts among those with the term, and twice the log likelihood by which that share
#: beats the share among all; of a hundred thousand words less than one gets there by chance.
MIN_PRECISION, MIN_EVIDENCE = 0.6, 30.0
STEM_LENGTHS = range(3, 9)
#: Precision by which a term must beat the stems that it begins with, or that begin with it.
MIN_GAIN = 0.1
#: Words before and after a hit in which quotation marks or reporting words are looked for.
WINDOW = 6
#: Texts that a rare combination is drawn to its class with.
SHRINK = 4.0
#: Probability from which a text is called toxic.
LIMIT = 0.3
SLICE_BYTES = 4 << 20

# Quotation marks, and words that report what somebody else said.
OPENING = "\"“„«‘'`"
CLOSING = "\"”“»’'´"
REPORTING = frozenset(
    "said says wrote writes quoted quote quotes called calling word term phrase insult slur "
    "sagte sagt schrieb zitat wort begriff dit écrit cité citation mot terme "
    "dijo dice escribió cita palabra término".split()
)

_WORD = re.compile(r"[^\W_]+")
_COUNTS = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64()), ("follows", pa.int64())])
_HIT = pa.struct([("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("n", pa.int64()), ("at", pa.int64())])
_HITS = ArrayType(
    StructType().add("term", "string").add("edits", "integer").add("quoted", "boolean").add("n", "long").add("at", "long")
)


class Term(NamedTuple):
    """A word, or with ``stem`` all words that begin with it."""

    text: str
    stem: bool

    @property
    def name(self) -> str:
        return self.text + "*" * self.stem

    @property
    def edits(self) -> int:
        """Edits that a misspelling may have."""
        if self.stem:
            return int(len(self.text) >= 6)
        return 0 if len(self.text) < 5 else 1 if len(self.text) < 9 else 2


def labelled_texts(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``text`` and ``toxic`` of the labelled documents."""
    texts = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # Labels grow with the documents; hashed by partition they spare a sort of the texts.
    return texts.join(one_label(labels, id_col, label_col).hint("shuffle_hash"), "doc_id")


def one_label(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    toxic = F.col(f"`{label_col}`").cast("int")
    found = labels.filter(toxic.isNotNull()).groupBy(F.col(f"`{id_col}`").alias("doc_id"))
    return found.agg((F.max(toxic) > 0).alias("toxic"))


def _word_counts(labelled: DataFrame) -> DataFrame:
    """``word``, texts it is in by label, and a bit for each class of words that it follows in toxic ones."""

    def run(batches):
        for batch, texts in text_slices(batches, "text", SLICE_BYTES):
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " ")
            per_text, codes, words = word_codes(plain)
            if not len(codes):
                continue
            text_no = np.repeat(np.arange(len(per_text)), per_text)
            pairs = np.unique(text_no * len(words) + codes)
            in_toxic = toxic[pairs // len(words)]
            counts = [np.bincount(pairs[w] % len(words), minlength=len(words)) for w in (in_toxic, ~in_toxic)]
            kinds = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) & 63 for w in words), np.int64, len(words))
            before = np.where(np.diff(text_no, prepend=-1) == 0, kinds[np.append(0, codes[:-1])], 63)
            follows = np.zeros(len(words), np.uint64)
            at = toxic[text_no]
            np.bitwise_or.at(follows, codes[at], np.uint64(1) << before[at].astype(np.uint64))
            yield record_batch(_COUNTS, word=words, toxic=counts[0], clean=counts[1], follows=follows.view(np.int64))

    parts = labelled.select("text", "toxic").mapInArrow(run, "word string, toxic long, clean long, follows long")
    return parts.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("follows").alias("follows")
    )


def learn_lexicon(labelled: DataFrame, terms: int = LEXICON_TERMS) -> list[Term]:
    """The terms that mark toxic texts (see ``labelled_texts``), strongest first."""
    counts = _word_counts(labelled)
    base = labelled.agg(F.avg(F.col("toxic").cast("int"))).first()[0]
    if not base or base == 1:
        return []
    lengths = F.array(*[F.lit(n) for n in STEM_LENGTHS])
    inner = F.filter(lengths, lambda n: n < F.char_length("word"))
    entry = F.explode(
        F.concat(
            F.array(F.struct(F.col("word").alias("text"), F.lit(False).alias("stem"))),
            F.transform(inner, lambda n: F.struct(F.substring("word", F.lit(1), n).alias("text"), F.lit(True).alias("stem"))),
        )
    )
    found = counts.select(entry.alias("e"), "toxic", "clean", "follows").groupBy("e").agg(
        F.sum("toxic").alias("in_toxic"),
        F.sum("clean").alias("clean"),
        F.bit_count(F.bit_or("follows")).alias("follows"),
        F.count("*").alias("words"),
    )
    # Toxic texts count by the words before the term, so that copies of one text count once.
    different = -64 * F.log(F.greatest(1 - F.col("follows") / 64, F.lit(1 / 128)))
    found = found.withColumn("toxic", F.least("in_toxic", different))
    precision = F.col("toxic") / (F.col("toxic") + F.col("clean") + 1)
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    against = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    evidence = 2 * (F.col("toxic") * F.log(share / base) + against)
    strong = found.filter(
        (F.col("toxic") >= MIN_TEXTS)
        & (F.col("follows") >= MIN_FOLLOWED)
        & (precision >= MIN_PRECISION)
        & (evidence >= MIN_EVIDENCE)
        & (~F.col("e.stem") | (F.col("words") >= MIN_STEM_WORDS))
    )
    strong = strong.select("e.text", "e.stem", precision.alias("precision"), evidence.alias("evidence"))
    rows = strong.orderBy(F.desc("evidence"), "text", "stem").limit(terms).collect()
    # Of entries that say the same, a stem and what begins with it, the strongest is enough.
    begins: dict[str, float] = {}
    kept: list[Term] = []
    for r in rows:
        nearest = max((begins.get(r.text[:n], 0.0) for n in range(1, len(r.text) + 1)), default=0.0)
        longer = max((p for s, p in begins.items() if r.stem and s.startswith(r.text)), default=0.0)
        if r.precision > max(nearest, longer) + MIN_GAIN:
            begins[r.text] = r.precision
            kept.append(Term(r.text, r.stem))
    return kept


class TermAutomaton:
    """The terms' trie and their Levenshtein automata as one deterministic automaton."""

    def __init__(self, terms: Iterable[Term]):
        self.terms = sorted(set(terms), key=lambda t: (-len(t.text), t.text, t.stem))
        children: list[dict[str, int]] = [{}]
        budget = [0]  # edits that a term at or below the node may have
        ends: list[list[int]] = [[]]
        for number, term in enumerate(self.terms):
            node = 0
            budget[0] = max(budget[0], term.edits)
            for c in term.text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    budget.append(0)
                    ends.append([])
                node = children[node][c]
                budget[node] = max(budget[node], term.edits)
            ends[node].append(number)
        self.alphabet = sorted({c for t in self.terms for c in t.text})

        def close(reached: dict[int, int]) -> dict[int, int]:
            """Add what characters left out of the word lead to."""
            todo = list(reached)
            while todo:
                node = todo.pop()
                spent = reached[node] + 1
                for child in children[node].values():
                    if spent <= budget[child] and spent < reached.get(child, 9):
                        reached[child] = spent
                        todo.append(child)
            return reached

        def step(positions: dict[int, int], c: str | None) -> dict[int, int]:
            reached: dict[int, int] = {}
            for node, spent in positions.items():
                more = spent + 1
                if more <= budget[node] and more < reached.get(node, 9):
                    reached[node] = more
                for d, child in children[node].items():
                    cost = spent if d == c else more
                    if cost <= budget[child] and cost < reached.get(child, 9):
                        reached[child] = cost
            return close(reached)

        def matches(positions: dict[int, int], stems: bool) -> tuple[int, int] | None:
            """Edits and number of the best term that ends here."""
            return min(
                ((e, t) for n, e in positions.items() for t in ends[n] if e <= self.terms[t].edits and (self.terms[t].stem or not stems)),
                default=None,
            )

        # State 0 is dead, 1 the beginning; a state also holds the best stem so far.
        start = close({0: 0})
        states: dict[tuple, int] = {(frozenset(), None): 0, (frozenset(start.items()), None): 1}
        todo: list[tuple[dict[int, int], tuple[int, int] | None]] = [({}, None), (start, None)]
        table: list[list[int]] = []
        best: list[tuple[int, int] | None] = []
        for positions, stem in todo:
            row = []
            for c in [None, *self.alphabet]:
                reached = step(positions, c) if positions else {}
                now = min((m for m in (stem, matches(reached, True)) if m), default=None)
                key = (frozenset(reached.items()), now)
                if key not in states:
                    states[key] = len(states)
                    todo.append((reached, now))
                row.append(states[key])
            table.append(row)
            best.append(min((m for m in (stem, matches(positions, False)) if m), default=None))
        self.table = np.array(table, np.int32)
        self.edits = np.array([-1 if m is None else m[0] for m in best], np.int32)
        self.term = np.array([-1 if m is None else m[1] for m in best], np.int32)
        self.last = np.array([not p for p, _ in todo], bool)  # nothing more can change
        self._codes = np.array([ord(c) for c in self.alphabet], np.uint32)

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The term that each word is or misspells, -1 for none, and the edits between them."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.searchsorted(self._codes, flat) if len(self._codes) else np.zeros(len(flat), np.int64)
        known = place < len(self._codes)
        known[known] = self._codes[place[known]] == flat[known]
        classes = np.where(known, place + 1, 0)
        first, _ = spans(size)
        state = np.ones(len(words), np.int32)
        live, at = np.flatnonzero(size > 0), 0
        while len(live):
            now = self.table[state[live], classes[first[live] + at]]
            state[live] = now
            at += 1
            live = live[~self.last[now] & (size[live] > at)]
        return self.term[state], self.edits[state]


def _is_quoted(tokens: list[str], at: int) -> bool:
    before, after = tokens[max(at - WINDOW, 0) : at], tokens[at + 1 : at + 1 + WINDOW]
    if any(_core(t) in REPORTING for t in before):
        return True
    opened = any(t[0] in OPENING for t in [*before, tokens[at]])
    # A mark that closes before the hit encloses something else.
    for t in reversed(before):
        if t.rstrip(".,;:!?")[-1:] in tuple(CLOSING):
            opened = tokens[at][0] in OPENING
            break
        if t[0] in OPENING:
            break
    return opened and any(t.rstrip(".,;:!?")[-1:] in tuple(CLOSING) for t in [tokens[at], *after])


def _core(token: str) -> str:
    found = _WORD.findall(token)
    return found[0] if found else ""


def find_terms(documents: DataFrame, terms: list[Term], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``found``: each term in the text by edits and quotation, how often, and at which
    word first."""
    automaton = TermAutomaton(terms)
    names = [t.name for t in automaton.terms]

    def run(batches):
        for batch, texts in text_slices(batches, "text", SLICE_BYTES):
            per_text, codes, tokens = word_codes(pc.utf8_lower(texts))
            parts = [_WORD.findall(t) for t in tokens]
            term, edits = automaton.match([w for p in parts for w in p])
            # A token is as near to a term as the nearest of its words.
            owner = np.repeat(np.arange(len(tokens)), [len(p) for p in parts])
            hit = np.flatnonzero(term >= 0)
            hit = hit[np.lexsort((term[hit], edits[hit], owner[hit]))]
            owned, at = np.unique(owner[hit], return_index=True)
            token_term, token_edits = np.full(len(tokens), -1), np.zeros(len(tokens), np.int64)
            token_term[owned], token_edits[owned] = term[hit[at]], edits[hit[at]]
            first, last = spans(per_text)
            places = np.flatnonzero(token_term[codes] >= 0) if len(codes) else np.zeros(0, np.int64)
            text_no = np.searchsorted(last, places, side="right")
            found: list[dict[tuple, list[int]]] = [{} for _ in range(len(per_text))]
            for place, no in zip(places.tolist(), text_no.tolist(), strict=True):
                low = max(place - WINDOW, int(first[no]))
                around = [tokens[c] for c in codes[low : min(place + 1 + WINDOW, int(last[no]))].tolist()]
                code = codes[place]
                key = (int(token_term[code]), int(token_edits[code]), _is_quoted(around, place - low))
                found[no].setdefault(key, [0, place - int(first[no])])[0] += 1
            rows = [
                [{"term": names[t], "edits": e, "quoted": q, "n": n, "at": p} for (t, e, q), (n, p) in f.items()] for f in found
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_HIT))], names=["doc_id", "found"])

    source = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(run, source.select("doc_id").schema.add("found", _HITS))


def _logit(p: float) -> float:
    return math.log(p) - math.log1p(-p)


class Weights(NamedTuple):
    """What is known of texts before and by each term, in log odds."""

    base: float
    without: float
    by_hit: dict[tuple[str, int, bool, bool], float]
    by_kind: dict[tuple[int, bool, bool], float]

    def score(self, hits) -> float:
        if not hits:
            return 1 / (1 + math.exp(-self.without))
        strongest: dict[str, float] = {}
        for h in hits:
            key = (h["term"], h["edits"], h["quoted"], h["n"] > 1)
            weight = self.by_hit.get(key, self.by_kind.get(key[1:], 0.0))
            strongest[h["term"]] = max(strongest.get(h["term"], -math.inf), weight)
        return 1 / (1 + math.exp(-max(min(self.base + sum(strongest.values()), 500.0), -500.0)))


def learn_weights(found: DataFrame, labels: DataFrame) -> Weights:
    """Weights from the terms found in texts and ``one_label`` of them; a row a combination reaches
    the driver, bounded by the lexicon."""
    joined = found.select("doc_id", "found").join(labels, "doc_id")
    is_toxic = F.count_if("toxic")
    hits = joined.select("toxic", F.explode_outer("found").alias("h"))
    kind = ("h.term", "h.edits", "h.quoted", (F.col("h.n") > 1).alias("again"))
    rows = hits.groupBy(*kind).agg(is_toxic.alias("toxic"), F.count("*").alias("n")).collect()
    totals = joined.agg(is_toxic.alias("toxic"), F.count("*").alias("n")).first()
    base = (totals.toxic + 0.5) / (totals.n + 1)
    no_hit = next(((r.toxic, r.n) for r in rows if r.term is None), (0, 0))
    without = (no_hit[0] + base) / (no_hit[1] + 1)
    kinds: dict[tuple[int, bool, bool], list[int]] = {}
    for r in rows:
        if r.term is not None:
            sums = kinds.setdefault((r.edits, r.quoted, r.again), [0, 0])
            sums[0] += r.toxic
            sums[1] += r.n
    # Quotations and misspellings are no evidence until enough labelled texts say so.
    draw = {k: 3 * SHRINK if k[1] else SHRINK if k[0] else 1.0 for k in kinds}
    share = {k: (toxic + draw[k] * base) / (n + draw[k]) for k, (toxic, n) in kinds.items()}
    by_hit = {
        (r.term, r.edits, r.quoted, r.again): _logit(
            (r.toxic + SHRINK * share[r.edits, r.quoted, r.again]) / (r.n + SHRINK)
        )
        - _logit(base)
        for r in rows
        if r.term is not None
    }
    return Weights(_logit(base), _logit(without), by_hit, {k: _logit(p) - _logit(base) for k, p in share.items()})


def score(found: DataFrame, weights: Weights, limit: float = LIMIT) -> DataFrame:
    """``doc_id``, ``found``, ``score`` from 0 to 1, and ``predicted``, 1 from the limit on."""

    def run(batches):
        for batch in batches:
            scores = np.array([weights.score(hits) for hits in batch.column("found").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("found"), pa.array(scores), pa.array((scores >= limit).astype(np.int32))],
                names=["doc_id", "found", "score", "predicted"],
            )

    schema = found.select("doc_id", "found").schema.add("score", "double").add("predicted", "integer")
    return found.select("doc_id", "found").mapInArrow(run, schema)
