"""Byte-pair encoding by speculation and verification, and decoding.

Encoding of a distinct word:

1. *Speculate*: tokens are proposed from the left, each the longest one of the vocabulary.
2. *Verify*: the proposal is the true encoding if and only if no merge would ever cross the
   border between two neighbouring tokens.  Undoing the merges of both in reverse order shows
   every pair of symbols that met at the border, and when.  All borders of all words of a
   batch are tested together, in lockstep over numpy arrays.
3. *Merge*: only words with a failing border are merged exactly, pair by pair; long ones by a
   heap of their pairs, so that a text without white space costs n log n steps.

Words are the pre-tokens of the tokenizer file.  Plain text is cut by its pattern here, and
pieces with special tokens or composing characters by the library's own normaliser and
pre-tokeniser; token ids always come from the three steps.

Defined cases: a null text counts as empty (no ids, the digest of nothing); repeated rows are
encoded each by itself; other columns stay as they are, and clashing result columns replace
them; an empty table gives an empty result; a very long text is encoded whole, in memory that
grows with its length.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vecspark.llm.batches import spans, text_slices, word_codes
from vecspark.llm.wordpieces import TOKEN_SLICE_BYTES, PieceEncoder

_NEVER = np.int64(1) << 40

#: Words of more symbols are merged one by one with a heap, shorter ones together in lockstep.
LOCKSTEP_SYMBOLS = 256


class Merges:
    """A vocabulary whose tokens are single symbols or made by one merge each.

    ``time[t]`` is when token ``t`` is made: 0 for symbols, the place of its merge from 1 on.
    """

    def __init__(self, vocab: dict[str, int], merges: list, end_of_word: str):
        self.vocab, self.end_of_word = vocab, end_of_word
        self.size = max(vocab.values(), default=-1) + 1
        self.time = np.zeros(self.size, np.int64)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.made = np.full(len(merges) + 1, -1, np.int64)
        keys, times = np.zeros(len(merges), np.int64), np.arange(1, len(merges) + 1)
        for when, merge in enumerate(merges, 1):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[a + b]
            if self.time[made]:
                raise ValueError(f"two merges make {a + b!r}")
            self.time[made], self.left[made], self.right[made] = when, vocab[a], vocab[b]
            self.made[when], keys[when - 1] = made, vocab[a] * self.size + vocab[b]
        order = np.argsort(keys)
        self.keys, self.key_time = keys[order], times[order]
        self.pair_time = dict(zip(keys.tolist(), times.tolist(), strict=True))
        # A token may be proposed only if its own text is encoded as that token.
        merged = np.flatnonzero(self.time)
        sound = np.ones(self.size, bool)
        whole = self.compatible(self.left[merged], self.right[merged], self.time[merged])
        for token, good in sorted(zip(merged.tolist(), whole.tolist(), strict=True), key=lambda x: self.time[x[0]]):
            sound[token] = good and sound[self.left[token]] and sound[self.right[token]]
        self.proposed = {text: token for text, token in vocab.items() if sound[token]}
        self.longest = max(map(len, self.proposed), default=1)

    def meeting_time(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """When the pairs merge; ``_NEVER`` if they don't."""
        if not len(self.keys):
            return np.full(len(a), _NEVER)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_time[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge before ``limit`` crosses the border between tokens ``a`` and ``b``."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NEVER) if limit is None else limit.copy()
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            good[live[self.meeting_time(x, y) < limit[live]]] = False
            # The later of the two merges is undone; of equal ones the right, which came second.
            undo_left = self.time[x] > self.time[y]
            later = np.where(undo_left, self.time[x], self.time[y])
            # A merge of the left part comes before one of the same kind on the right.
            limit[live] = np.where(undo_left, later, later + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            live = live[good[live] & (later > 0)]
        return good

    def propose(self, word: str) -> list[int] | None:
        """Longest tokens from the left; None if a symbol has no token."""
        text, proposed, found, at = word, self.proposed, [], 0
        end, last = len(word), word + self.end_of_word
        while at < end:
            token = proposed.get(last[at:]) if end - at <= self.longest else None
            if token is not None:
                found.append(token)
                return found
            for stop in range(min(end - 1, at + self.longest), at, -1):
                token = proposed.get(text[at:stop])
                if token is not None:
                    break
            else:
                return None
            found.append(token)
            at = stop
        return found

    def symbols(self, word: str) -> list[int]:
        """The single symbols of a word; those that the vocabulary lacks are left out."""
        parts = [*word[:-1], word[-1] + self.end_of_word] if word else []
        return [self.vocab[s] for s in parts if s in self.vocab]

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """Exact merging: always the earliest pair of a word, of equal ones the leftmost."""
        found = {i: self.merge_long(w) for i, w in enumerate(words) if len(w) > LOCKSTEP_SYMBOLS}
        short = iter(self.merge_short([w for i, w in enumerate(words) if i not in found]))
        return [found[i] if i in found else next(short) for i in range(len(words))]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """One word, whose pairs wait in a heap; n log n steps."""
        tokens, n, size, times, made = array("q", symbols), len(symbols), self.size, self.pair_time, self.made.tolist()
        before, after = array("q", range(-1, n - 1)), array("q", range(1, n + 1))
        pairs = tokens[:-1], tokens[1:]
        waiting = [t * n + i for i, (a, b) in enumerate(zip(*pairs)) if (t := times.get(a * size + b))]
        heapify(waiting)
        while waiting:
            time, at = divmod(heappop(waiting), n)
            right = after[at]
            # The pair may have lost a side to another merge meanwhile.
            if tokens[at] < 0 or right >= n or times.get(tokens[at] * size + tokens[right]) != time:
                continue
            tokens[at], tokens[right] = made[time], -1
            follower = after[at] = after[right]
            if follower < n:
                before[follower] = at
                if t := times.get(tokens[at] * size + tokens[follower]):
                    heappush(waiting, t * n + at)
            if (previous := before[at]) >= 0 and (t := times.get(tokens[previous] * size + tokens[at])):
                heappush(waiting, t * n + previous)
        return [t for t in tokens if t >= 0]

    def merge_short(self, words: list[list[int]]) -> list[list[int]]:
        """All words together, one merge of each word a round."""
        done: list[list[int]] = [[] for _ in words]
        count = np.fromiter(map(len, words), np.int64, len(words))
        tokens = np.fromiter((t for w in words for t in w), np.int64, int(count.sum()))
        word = np.repeat(np.arange(len(words)), count)

        def pair_times(at: np.ndarray) -> np.ndarray:
            times = np.full(len(at), _NEVER)
            inner = np.flatnonzero((at + 1 < len(tokens)) & (at >= 0))
            inner = inner[word[at[inner]] == word[at[inner] + 1]]
            times[inner] = self.meeting_time(tokens[at[inner]], tokens[at[inner] + 1])
            return times

        times = pair_times(np.arange(len(tokens)))
        while len(tokens):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            size = np.diff(starts, append=len(tokens))
            earliest = np.minimum.reduceat(times, starts)
            at = np.flatnonzero((times == np.repeat(earliest, size)) & (times < _NEVER))
            at = at[np.diff(word[at], prepend=-1) != 0]
            tokens[at] = self.made[times[at]]
            stay = np.ones(len(tokens), bool)
            stay[at + 1] = False
            ended = np.flatnonzero(earliest >= _NEVER)
            for k in ended.tolist():
                a = starts[k]
                done[word[a]] = tokens[a : a + size[k]].tolist()
            stay &= ~np.repeat(earliest >= _NEVER, size)
            changed = (np.cumsum(stay) - 1)[at]
            tokens, word, times = tokens[stay], word[stay], times[stay]
            for near in (changed, changed[changed > 0] - 1):
                times[near] = pair_times(near)
        return done

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """The tokens of each word, and how many words had to be merged exactly."""
        guesses = [self.propose(w) for w in words]
        failing = {i for i, g in enumerate(guesses) if g is None}
        count = np.fromiter((len(g or ()) for g in guesses), np.int64, len(guesses))
        flat = np.fromiter((t for g in guesses for t in g or ()), np.int64, int(count.sum()))
        of_word = np.repeat(np.arange(len(words)), count)
        border = np.flatnonzero(of_word[1:] == of_word[:-1])
        pairs, which = np.unique(flat[border] * self.size + flat[border + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing.update(of_word[border[~good[which]]].tolist())
        redo = sorted(failing)
        for i, tokens in zip(redo, self.merge([self.symbols(words[i]) for i in redo]), strict=True):
            guesses[i] = tokens
        return guesses, len(redo)


class SpeculativeEncoder(PieceEncoder):
    """Ids of pieces by speculation and verification."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError(f"{path} needs more than merges")
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.special_ids = {s: self.library.token_to_id(s) for s in self.special}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]

    def model_ids(self, words: list[str]) -> list[list[int]]:
        symbols = [w.encode().decode("latin-1").translate(self.alphabet) for w in words]
        return self.merges.encode_words(symbols)[0]

    def whole_ids(self, pieces: list[str]) -> list[list[int]]:
        normalizer, cutter = self.library.normalizer, self.library.pre_tokenizer
        parts, words = [], []
        for piece in pieces:
            own = []
            for part in self.cut_special.split(piece) if self.cut_special else [piece]:
                if part in self.special_ids:
                    own.append(self.special_ids[part])
                elif part:
                    found = [w for w, _ in cutter.pre_tokenize_str(normalizer.normalize_str(part))]
                    own += [(len(words) + i,) for i in range(len(found))]
                    words += found
            parts.append(own)
        ids = self.merges.encode_words(words)[0]
        return [
            [i for p in own for i in (ids[p[0]] if isinstance(p, tuple) else [p])] for own in parts
        ]

    def decode_pieces(self, ids: list[int]) -> str:
        """Decoding of a tokenizer without a decoder: the tokens, one space between two."""
        names = self.names
        return " ".join([names[i] for i in ids])


def encode_and_decode(documents: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """All columns but the text, with ``n_tokens``, the digest of the ids (32-bit little-endian)
    and the digest of the text that they decode to."""
    if Tokenizer.from_file(tokenizer).decoder is not None:
        raise ValueError(f"{tokenizer} decodes in another way than by joining tokens")
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    kept = [c for c in documents.columns if c != text_col and c not in added]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        encoder = SpeculativeEncoder(tokenizer)
        for batch, texts in text_slices(batches, "_text", TOKEN_SLICE_BYTES):
            per_text, codes, pieces = word_codes(texts)
            count, ids = encoder.encode_pieces(pieces)
            first, last = spans(count)
            ids = ids.astype("<u4")
            flat = ids.tolist()
            raw = [ids[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            decoded = [encoder.decode_pieces(flat[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            start, end = spans(per_text)
            codes = codes.tolist()
            tokens, of_ids, of_text = [], [], []
            for a, b in zip(start.tolist(), end.tolist(), strict=True):
                own = codes[a:b]
                joined = b"".join([raw[c] for c in own])
                tokens.append(len(joined) // 4)
                of_ids.append(hashlib.sha256(joined).hexdigest())
                text = " ".join([decoded[c] for c in own if raw[c]])
                of_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array(tokens, pa.int64()), pa.array(of_ids), pa.array(of_text),
                ],
                names=[*kept, *added],
            )

    schema = source.drop("_text").schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return source.mapInArrow(run, schema)
