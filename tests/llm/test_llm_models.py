"""Language identification and the class-based model, against plain versions."""

import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest

from llm_support import docs, edge_frame, sentence, words_of
from vecspark.llm.class_lm import ADDED, CLASSES, MOVE_COST, TRANSITION_PRIOR, Items, best_classes
from vecspark.llm import class_lm
from vecspark.llm.class_lm import count_pairs, ending_of, exchange_clusters, learn, learn_and_score, score
from vecspark.llm.language_id import PLACES, Profiles, identify_language, learn_profiles
from vecspark.sources.workspace import materialize

SYLLABLES = {"aa": ["the", "ing", "sh", "wh", "th"], "bb": ["eau", "é", "ç", "oux", "ment"], "cc": ["sch", "ung", "ü", "keit", "ß"]}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def plain_grams(text):
    found, word = Counter(), ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
            continue
        if word:
            padded = f"\x01{word}\x01"
            for n in (1, 2, 3):
                found.update(g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != "\x01" and (n < 3 or g[1] != "\x01"))
        word = ""
    return found


def code_of(gram):
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


def plain_profile(count, places=PLACES):
    return [g for _, g in sorted((-n, code_of(g)) for g, n in count.items())][:places]


def test_profiles_and_predictions_agree_with_plain_ones(spark):
    rng = random.Random(1)
    rows = [(i, spoken(rng, lang, rng.randint(5, 60)), lang, None) for i, lang in enumerate(random.Random(2).choices(list(SYLLABLES), k=80))]
    rows += [(900, "nothing is learned here", None, None), (901, None, "aa", None)]
    frame = docs(spark, rows).repartition(5)
    want = {lang: sum((plain_grams(t) for _, t, x, _ in rows if x == lang and t), Counter()) for lang in SYLLABLES}
    profiles = learn_profiles(frame)
    assert profiles == {lang: plain_profile(c) for lang, c in want.items()}
    short = {lang: grams[:50] for lang, grams in profiles.items()}
    held = [(i, spoken(rng, lang, 12), lang, None) for i, lang in enumerate([*SYLLABLES] * 10)]
    found = identify_language(docs(spark, held), short, places=50).collect()
    for r in found:
        own = plain_profile(plain_grams(r.text), 50)
        off = {
            lang: sum(abs(i - grams.index(g)) if g in grams else 50 for i, g in enumerate(own)) / (50 * len(own))
            for lang, grams in short.items()
        }
        best = min(off, key=lambda x: (off[x], x))
        assert r.lang_pred == best and math.isclose(r.score, 1 - off[best])
    assert sum(r.lang_pred == r.lang for r in found) >= 0.95 * len(found)


def test_language_edges(spark):
    frame = edge_frame(spark).withColumnRenamed("source", "score")
    profiles = learn_profiles(frame)
    found = identify_language(frame, profiles)
    assert found.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score"]
    assert found.count() == frame.count()
    for r in found.collect():
        letters = any(unicodedata.category(c)[0] == "L" for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert learn_profiles(frame.limit(0)) == {}
    assert {r.lang_pred for r in identify_language(frame, {}).collect()} == {"und"}
    assert not identify_language(frame.limit(0), profiles).collect()
    assert Profiles(profiles, PLACES).nearest("12 34") == ("und", 0.0)


def likelihood(pairs, assigned, classes):
    member = np.eye(classes)[assigned]
    table = member.T @ pairs @ member

    def f(x):
        return float((x * np.log(np.maximum(x, 1))).sum())

    return f(table) - f(table.sum(axis=0)) - f(table.sum(axis=1))


def test_no_exchange_of_one_item_raises_the_likelihood():
    rng = np.random.default_rng(3)
    size, classes = 40, 6
    group = rng.integers(0, 4, size)
    pairs = rng.poisson(np.where(group[None, :] == (group[:, None] + 1) % 4, 20, 1)).astype(float)
    found = exchange_clusters(pairs, classes, sweeps=100)
    assert found[-1] == classes - 1 and (found == classes - 1).sum() == 1
    best = likelihood(pairs, found, classes)
    order = np.argsort(-pairs.sum(axis=0)[:-1], kind="stable")
    start = np.empty(size, int)
    start[order], start[-1] = np.arange(size - 1) % (classes - 1), classes - 1
    assert best > likelihood(pairs, start, classes)
    for item in range(size - 1):
        for other in range(classes - 1):
            moved = found.copy()
            moved[item] = other
            assert likelihood(pairs, moved, classes) <= best + 1e-6


def plain_base(rows, training):
    count = Counter(w for i, t in rows if i in training for w in [*words_of(t), None])
    total, distinct = sum(count.values()), len(count)
    log = {w: math.log10((count[w] + ADDED) / (total + ADDED * (distinct + 1))) for _, t in rows for w in [*words_of(t), None]}
    return count, total, log


@pytest.mark.parametrize("head_words", [0, 8, 50_000])
def test_model_agrees_with_counts(spark, head_words):
    rng = random.Random(4)
    rows = [(i, spoken(rng, rng.choice(list(SYLLABLES)), rng.randint(0, 40))) for i in range(120)] + [(500, None), (501, " ")]
    training = {i for i, _ in rows if i % 5 != 1}
    frame = docs(spark, rows).repartition(4)
    model, counts = learn(frame.filter("doc_id % 5 <> 1"), head_words)
    found = {r.doc_id: r for r in score(frame.select("doc_id", "text"), model, counts).collect()}
    count, total, log = plain_base(rows, training)
    assert {r.word: r.n for r in counts.collect()} == {w.decode(): n for w, n in count.items() if w is not None}
    for i, t in rows:
        words = [*words_of(t), None]
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), total)
        assert math.isclose(r.base_score, sum(log[w] for w in words), rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    if head_words:
        held = [found[i] for i, _ in rows if i not in training]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # The classes of all words give transitions, emissions and every score.
    of = {r.word: r["class"] for r in counts.collect()}

    def class_of(word):
        return of.get(word, model.ending_class[ending_of(word)])

    table, mass = np.zeros((CLASSES, CLASSES)), np.zeros(CLASSES)
    for i, t in rows:
        if i in training:
            path = [CLASSES - 1, *(class_of(w.decode()) for w in words_of(t)), CLASSES - 1]
            for x, y in zip(path, path[1:]):
                table[x, y] += 1
    for w, n in count.items():
        mass[class_of(w.decode()) if w is not None else CLASSES - 1] += n + ADDED
    for c in model.ending_class:  # what is kept for unseen words
        mass[c] += ADDED
    share = np.where(mass > 0, table.sum(axis=0) + 1, 0)
    after = (table + TRANSITION_PRIOR * share / share.sum()) / (table.sum(axis=1, keepdims=True) + TRANSITION_PRIOR)
    assert np.allclose(after.sum(axis=1), 1) and np.allclose(model.mass, mass) and np.allclose(model.transition, after)
    for i, t in rows:
        words = [w.decode() for w in words_of(t)]
        path = [CLASSES - 1, *map(class_of, words), CLASSES - 1]
        want = sum(math.log10(after[x, y]) for x, y in zip(path, path[1:]))
        want += sum(math.log10((count[w.encode()] + ADDED) / mass[class_of(w)]) for w in words)
        assert math.isclose(found[i].score, want, rel_tol=1e-9)


def test_moves_of_words_follow_the_likelihood():
    rng = np.random.default_rng(5)
    classes, words = 6, 50
    old = rng.integers(0, classes - 1, words)
    follow, precede = rng.poisson(1.5, (2, words, classes)).astype(float)
    like = rng.integers(0, classes - 1, words)  # the class whose places a word stands in
    follow[np.arange(words), (like + 1) % 5] += rng.integers(1, 9, words)
    precede *= 0
    for w in range(words):  # as many before as after
        precede[w] = rng.multinomial(int(follow[w].sum()), np.full(classes, 1 / classes))
    table = rng.poisson(30, (classes, classes)).astype(float)
    table[np.arange(5), (np.arange(5) + 1) % 5] += 400
    for w in range(words):
        table[old[w]] += follow[w]
        table[:, old[w]] += precede[w]

    held = table.sum(axis=0)
    share = (held + 1) / (held + 1).sum()

    def gain(w, k):
        """log likelihood of a word's neighbours and of the word itself in class k without it."""
        mine = k == old[w]
        n, left = precede[w].sum(), table.sum(axis=1)
        found = -n * math.log(held[k] + (0 if mine else n) + ADDED)
        for c in range(classes):
            out, into = table[k, c] - mine * follow[w, c], table[c, k] - mine * precede[w, c]
            before = left[k] - mine * n + TRANSITION_PRIOR
            found += follow[w, c] * math.log((max(out, 0) + TRANSITION_PRIOR * share[c]) / before)
            found += precede[w, c] * math.log((max(into, 0) + TRANSITION_PRIOR * share[k]) / (left[c] + TRANSITION_PRIOR))
        return found

    found = best_classes(follow, precede, old, table)
    gains = np.array([[gain(w, k) for k in range(classes - 1)] for w in range(words)])
    rows, best = np.arange(words), gains.argmax(axis=1)
    pays = gains[rows, best] > gains[rows, old] + MOVE_COST
    assert (found == np.where(pays, best, old)).all() and (found != old).any() and (best[~pays] != old[~pays]).any()


def test_rare_words_move_by_their_neighbours(spark):
    """Words that end alike join the frequent word that stands in the same places."""
    rng = random.Random(6)
    frames = [("le", "chat", "rouge"), ("der", "hund", "blau")]
    kind = {f"w{i}x{'abcdefgh'[i % 8]}ing": i % 2 for i in range(60)}
    rows = []
    for i in range(3_000):
        word = rng.choice(sorted(kind))
        left, right, frequent = frames[kind[word]]
        rows.append((i, f"{left} {word if i % 2 else frequent} {right} {left} {right}"))
    _, counts = learn(docs(spark, rows).repartition(4), 6)
    of = {r.word: r["class"] for r in counts.collect()}
    assert of["rouge"] != of["blau"]
    assert all(of[w] != of[frames[1 - k][2]] for w, k in kind.items())
    assert sum(of[w] == of[frames[k][2]] for w, k in kind.items()) >= 55


def test_pairs_are_counted(spark):
    rows = [(1, "a b a"), (2, None), (3, "B a")]
    items = Items({"a": 0, "b": 1}, 2)
    pairs = count_pairs(docs(spark, rows).repartition(3).select("text"), items)
    end = items.end
    assert pairs[0, 1] == 1 and pairs[1, 0] == 2 and pairs[end, end] == 1
    assert pairs[end, 0] == 1 and pairs[end, 1] == 1 and pairs[0, end] == 2 and pairs.sum() == 8


def test_model_edges(spark):
    frame = edge_frame(spark).withColumnRenamed("source", "score")
    model, counts = learn(frame.filter("doc_id > 100"))
    found = score(frame, model, counts)
    assert found.columns == ["doc_id", "lang", "n_chars", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert found.count() == frame.count()
    assert all((r.n_known, r.train_tokens) == (0, 0) and abs(r.base_score) < 1e-9 for r in found.collect())
    model, counts = learn(frame)
    rows = score(frame, model, counts).collect()
    assert all(r.n_known == r.n_tokens for r in rows) and len(rows) == frame.count()
    assert not score(frame.limit(0), model, counts).collect()
    assert sentence(random.Random(1), 3)


@pytest.mark.parametrize("head_words", [0, 8, 50_000])
def test_one_pass_over_training_and_other_texts_scores_alike(spark, monkeypatch, head_words):
    """Words are shuffled once for classes and scores; slices and working blocks are far smaller than by default."""
    for name, value in (("TEXT_BYTES", 300), ("_WORD_ROWS", 7), ("_WORDS", 3), ("_PATH_BYTES", 50)):
        monkeypatch.setattr(class_lm, name, value)
    rng = random.Random(8)
    rows = [(i, spoken(rng, rng.choice(list(SYLLABLES)), rng.randint(0, 40))) for i in range(120)]
    rows += [(500, None), (501, " "), (500, "the x the " * 30), (502, "y" * 90 + " ING"), (505, "y" * 90), (506, "unseen")]
    frame = docs(spark, rows).repartition(4)
    model, counts = learn(frame.filter("doc_id % 5 <> 1"), head_words)
    want = sorted(score(frame, model, counts).collect(), key=str)
    result = learn_and_score(frame, frame["doc_id"] % 5 != 1, head_words=head_words)
    found = sorted(result.collect(), key=str)
    assert result.columns == score(frame, model, counts).columns and len(found) == len(rows)
    for r, x in zip(found, want, strict=True):
        assert r[:-2] == x[:-2]
        assert math.isclose(r.base_score, x.base_score, rel_tol=1e-9) and math.isclose(r.score, x.score, rel_tol=1e-9)


def test_one_pass_edges(spark):
    frame = edge_frame(spark).withColumnRenamed("source", "score")
    found = learn_and_score(frame, frame["doc_id"] > 100)
    assert found.columns == ["doc_id", "lang", "n_chars", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert found.count() == frame.count()
    assert all((r.n_known, r.train_tokens) == (0, 0) and abs(r.base_score) < 1e-9 for r in found.collect())
    rows = learn_and_score(frame, frame["doc_id"].isNotNull() | frame["doc_id"].isNull()).collect()
    assert all(r.n_known == r.n_tokens for r in rows) and len(rows) == frame.count()
    assert not learn_and_score(frame.limit(0), frame["doc_id"] > 0).collect()


def test_a_rare_token_is_shuffled_by_word_once(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i * 7 + j}" for j in range(9))) for i in range(40)]
    plans = []

    def record(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(class_lm, "materialize", record)
    frame = docs(spark, rows)
    assert learn_and_score(frame, frame["doc_id"] % 5 != 1, head_words=8).count() == 40
    assert sum("RepartitionByExpression" in p for p in plans) == 1 and not any("Join" in p or "Window" in p for p in plans)
