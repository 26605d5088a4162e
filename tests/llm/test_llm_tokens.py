"""Token counts, packing and byte-pair encoding agree with the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_support import TOKENIZER, docs, edge_frame, odd_texts, sentence
from vecspark.llm.bpe import Merges, SpeculativeEncoder, encode_and_decode
from vecspark.llm.packing import OpenWindows, Window, fill_up, pack
from vecspark.llm.token_counts import count_tokens, spliced_count


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def strange(rng, n):
    alphabet = [*"ab Z'sS\t\n\v\x1c\x85\xa0é<|>12½ª", "<|endoftext|>", "́", "İ", "Σ", "日本", "😀", "'ll", "  ", "가", "the", "ing", "!!!!"]
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_counts_agree(spark, library):
    frame = edge_frame(spark)
    found = count_tokens(frame.withColumnRenamed("n_chars", "n_tokens"), TOKENIZER, limit=5, chunk_chars=500, overlap_chars=4)
    assert found.columns == ["doc_id", "lang", "source", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect())
    want = []
    for r in frame.collect():
        n = len(ids_of(library, r.text))
        want.append((r.doc_id or -1, len((r.text or "").encode()), n, n > 5))
    assert got == sorted(want)
    assert not count_tokens(frame.limit(0), TOKENIZER).collect()


def test_splices_are_exact(library):
    rng = random.Random(3)
    for _ in range(400):
        text = strange(rng, rng.randint(0, 150))
        assert spliced_count(library, text, rng.choice([5, 20, 60]), rng.choice([1, 4, 16])) == len(ids_of(library, text))
    assert spliced_count(library, "x" * 3_000, 100, 10) == len(ids_of(library, "x" * 3_000))


def test_speculation_is_exact(library):
    encoder, rng = SpeculativeEncoder(TOKENIZER), random.Random(4)
    import pyarrow as pa

    texts = [strange(rng, rng.randint(0, 40)) for _ in range(2_000)] + [t or "" for t in odd_texts()]
    count, ids = encoder.encode(pa.array(texts, pa.large_string()))
    at = 0
    for text, n in zip(texts, count.tolist(), strict=True):
        found = ids[at : at + n].tolist()
        at += n
        assert found == ids_of(library, text), text
        assert encoder.decode_pieces(found) == library.decode(found, skip_special_tokens=False)


def test_verification_agrees_with_merging():
    rng = random.Random(5)
    for _ in range(60):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        while len(merges) < 12:
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if a + b not in vocab:
                merges.append([a, b])
                vocab[a + b] = len(vocab)
        table = Merges(vocab, merges, "")
        words = ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(80)]
        exact = table.merge([table.symbols(w) for w in words])
        assert [table.merge_long(table.symbols(w)) for w in words] == exact
        assert table.encode_words(words)[0] == exact
        for word, tokens in zip(words, exact, strict=True):
            plain = list(word)
            while True:
                ranks = [(merges.index([x, y]), i) for i, (x, y) in enumerate(zip(plain, plain[1:])) if [x, y] in merges]
                if not ranks:
                    break
                _, i = min(ranks)
                plain[i : i + 2] = [plain[i] + plain[i + 1]]
            assert [vocab[p] for p in plain] == tokens


def test_long_words_and_texts_are_encoded_whole(library):
    """Words of 200,000 and 300 letters, repeated pairs, and a text of 5 MB."""
    encoder, rng = SpeculativeEncoder(TOKENIZER), random.Random(8)
    import pyarrow as pa

    def letters(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))

    texts = [letters(200_000), letters(300), "ab" * 5_000 + "a", "aaa" * 3_000, "".join(rng.choices("ab/+9Zq", k=20_000))]
    texts.append(" ".join(sentence(rng, 50) for _ in range(100)) + " ")
    texts[-1] *= 5_000_000 // len(texts[-1]) + 1
    count, ids = encoder.encode(pa.array(texts, pa.large_string()))
    assert count.sum() == len(ids)
    at = 0
    for text, n in zip(texts, count.tolist(), strict=True):
        assert ids[at : at + n].tolist() == ids_of(library, text)
        at += n


def test_round_trip_digests(spark, library):
    frame = edge_frame(spark)
    found = encode_and_decode(frame, TOKENIZER)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect())
    want = []
    for r in frame.collect():
        ids = ids_of(library, r.text)
        text = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), text.encode())]
        want.append((r.doc_id or -1, len(ids), *digests))
    assert got == sorted(want)
    assert not encode_and_decode(frame.limit(0), TOKENIZER).collect()


def check_packing(rows, texts, library, size):
    """Every id is in one piece, sequences have no gaps."""
    ids = {i: [*ids_of(library, t), 1] for i, t in texts.items()}
    covered, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert covered == {i: len(x) for i, x in ids.items()}
    fills = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        fills.append(at)
    return fills


@pytest.mark.parametrize("merged_at_once", [1, 2, 5, 1_000])
def test_packing_is_whole(spark, library, merged_at_once):
    rng = random.Random(6)
    texts = {i: sentence(rng, rng.choice([0, 1, 5, 30, 200])) for i in range(150)}
    frame = docs(spark, list(texts.items())).repartition(7)
    rows = pack(frame, TOKENIZER, window_tokens=128, open_windows=4, merged_at_once=merged_at_once).collect()
    fills = check_packing(rows, texts, library, 128)
    assert sum(fills) >= 0.9 * 128 * len(fills)


def test_packing_edges(spark, library):
    texts = dict(enumerate(odd_texts()))
    rows = pack(docs(spark, list(texts.items())), TOKENIZER).collect()
    check_packing(rows, texts, library, 2048)
    twice = pack(docs(spark, [(1, "a b"), (1, "a b"), (None, None)]), TOKENIZER).collect()
    assert sorted((r.doc_id or -1, r.start, r.length) for r in twice) == [(-1, 0, 1), (1, 0, 3), (1, 0, 3)]
    assert not pack(docs(spark, [(1, "x")]).limit(0), TOKENIZER).collect()


def test_best_fit_and_emission():
    windows = OpenWindows(10, 2)
    assert windows.place([{"k": 1}], 7) is None and windows.place([{"k": 2}], 5) is None
    assert windows.place([{"k": 3}], 3).fill == 10  # the fuller window of two that fit
    windows.place([{"k": 4}], 8)
    assert windows.place([{"k": 5}], 9).pieces == [{"k": 4}]  # the fullest goes
    open_ = [Window(n, [{"start": 0, "ids": np.arange(n)}]) for n in (3, 7, 6)]
    assert sorted(w.fill for w in fill_up(open_, 8)) == [8, 8]
