"""Token ids of whitespace-separated pieces, each distinct piece encoded once.

This serves tokenizers that drop white space, such as ``word_bpe_49k.json``: their
pre-tokeniser never matches across white space, no composition of characters reaches over it
and no special token holds any, so a text's ids are the ids of its pieces one after another.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from vecspark.llm.batches import ragged_take, spans, word_codes

# Fixed value: the pre-tokeniser pattern that the tokenizer file names.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_OR_END = regex.compile(PRE_TOKEN + r"|\n")
# Characters that compose with nothing and are classed alike by every Unicode version.
PLAIN = regex.compile("[\x21-\x7e¡-įı-˿]*")

#: Text that is encoded at a time; in larger slices more words are seen once for all.
TOKEN_SLICE_BYTES = 16 << 20
#: Distinct words whose ids a task remembers; beyond it the memory starts anew.
MAX_REMEMBERED = 1_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class PieceEncoder:
    """Ids of pieces by the tokenizers library; plain words go straight to its model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        patterns = [
            p.get("pattern", {}).get("Regex", "").replace("[\\p{L}]", "\\p{L}").replace("[\\p{N}]", "\\p{N}")
            for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        ]
        if PRE_TOKEN not in patterns:
            raise ValueError(f"{path} cuts texts by another pattern than {PRE_TOKEN}")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.alphabet = str.maketrans(dict(enumerate(byte_alphabet())))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = array("I")
        self.ends = array("q", [0])

    def model_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of words that the pre-tokeniser leaves whole."""
        tokenize = self.library.model.tokenize
        return [
            [t.id for t in tokenize(w.encode().decode("latin-1").translate(self.alphabet))]
            for w in words
        ]

    def whole_ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces with special tokens or characters that compose."""
        return [
            e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)
        ]

    def remember(self, keys: list[str], encode: Callable, strip: int = 0) -> None:
        for key, ids in zip(keys, encode([k[strip:] for k in keys]), strict=True):
            self.known[key] = len(self.ends) - 1
            self.flat.extend(ids)
            self.ends.append(len(self.flat))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids per piece, and all ids in order."""
        if len(self.known) > MAX_REMEMBERED:
            self.forget()
        odd = [
            i
            for i, p in enumerate(pieces)
            if not PLAIN.fullmatch(p) or any(s in p for s in self.special)
        ] if not PLAIN.fullmatch("".join(pieces)) or any(s in "".join(pieces) for s in self.special) else []
        kept = list(pieces)
        for i in odd:
            kept[i] = ""
        words = WORD_OR_END.findall("\n".join([*kept, ""]).lower())
        encoded = pa.array(words, pa.large_string()).dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False)
        distinct = encoded.dictionary.to_pylist()
        end = distinct.index("\n") if pieces else -1
        is_end = code == end
        in_piece = np.diff(np.flatnonzero(is_end), prepend=-1) - 1
        self.remember(
            [w for i, w in enumerate(distinct) if i != end and w not in self.known], self.model_ids
        )
        # A leading line feed keeps whole pieces apart from words.
        whole = ["\n" + pieces[i] for i in odd]
        self.remember(
            list(dict.fromkeys(w for w in whole if w not in self.known)), self.whole_ids, strip=1
        )
        numbers = np.array([-1 if i == end else self.known[w] for i, w in enumerate(distinct)], np.int64)
        number = numbers[code[~is_end]]
        if odd:
            number = np.insert(number, spans(in_piece)[0][odd], [self.known[w] for w in whole])
            in_piece[odd] = 1
        flat, ends = np.frombuffer(self.flat, np.uint32), np.frombuffer(self.ends, np.int64)
        count = ends[number + 1] - ends[number]
        ids = ragged_take(flat, ends[number], count)
        del flat, ends  # an array that is looked at can't grow
        start, stop = spans(in_piece)
        total = np.concatenate([[0], np.cumsum(count)])
        return total[stop] - total[start], ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text, and all ids in order."""
        per_text, codes, pieces = word_codes(texts)
        count, ids = self.encode_pieces(pieces)
        first, _ = spans(count)
        total = np.concatenate([[0], np.cumsum(count[codes])])
        start, end = spans(per_text)
        return total[end] - total[start], ragged_take(ids, first[codes], count[codes])

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Ids per text."""
        per_text, codes, pieces = word_codes(texts)
        total = np.concatenate([[0], np.cumsum(self.encode_pieces(pieces)[0][codes])])
        start, end = spans(per_text)
        return total[end] - total[start]
