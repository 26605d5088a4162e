"""Toxicity, prefix tries and centroid clustering against brute force and planted cases."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from vecspark.llm.centroid_clustering import Bisectors, cluster, cluster_report
from vecspark.llm.prefix_trie import NO_ENDS, ordered_turns, prefix_trie
from vecspark.llm.toxicity import (
    Term,
    TermAutomaton,
    find_terms,
    labelled_texts,
    learn_lexicon,
    learn_weights,
    one_label,
    score,
)

# Toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_match(word, terms):
    """Edits and place of the best term, by trying all."""
    ordered = sorted(terms, key=lambda t: (-len(t.text), t.text, t.stem))
    found = []
    for number, t in enumerate(ordered):
        near = min(edits(word[:n], t.text) for n in range(len(word) + 1)) if t.stem else edits(word, t.text)
        if near <= t.edits:
            found.append((near, number))
    return min(found, default=None)


@pytest.mark.parametrize("seed", range(6))
def test_automaton_finds_what_trying_all_terms_finds(seed):
    rng = random.Random(seed)
    word = lambda low, high: "".join(rng.choices("abcé", k=rng.randint(low, high)))
    terms = {Term(word(3, 11), rng.random() < 0.3) for _ in range(12)}
    automaton = TermAutomaton(terms)
    words = [word(1, 14) for _ in range(300)] + [t.text for t in terms] + ["", "z", "a" * 200_000]
    for t in terms:  # near misses
        for _ in range(4):
            at = rng.randrange(len(t.text))
            words.append(t.text[:at] + rng.choice(["", "z", "a" + t.text[at]]) + t.text[at + 1 :])
    term, spent = automaton.match(words)
    for w, t, e in zip(words, term.tolist(), spent.tolist(), strict=True):
        if len(w) < 1000:
            assert (None if t < 0 else (e, t)) == brute_match(w, terms), w


def toxic_corpus(rng, n=400):
    filler = ["".join(rng.choices("abcdeghij", k=rng.randint(2, 6))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(filler, k=30)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilewret", "foulmouth", "zorkan" + rng.choice(["te", "su", "lor"])]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels, filler


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows, labels, filler = toxic_corpus(random.Random(5))
    # Many copies of one toxic text must not make terms of its words.
    rows += [(1000 + i, "odd copied words stand here") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = learn_lexicon(labelled_texts(docs, known))
    return docs, known, lexicon, learn_weights(find_terms(docs, lexicon), one_label(known)), filler


def test_lexicon_holds_terms_and_stems(toxic_model):
    lexicon = toxic_model[2]
    assert {t.text for t in lexicon if not t.stem} | {t.text for t in lexicon if t.stem} <= {
        w[:n] for w in ("vilewret", "foulmouth", "zorkante") for n in range(3, 10)
    }
    matched = TermAutomaton(lexicon).match(["vilewret", "foulmouth", "zorkanxyz", "copied", "stand"])[0]
    assert (matched[:3] >= 0).all() and (matched[3:] < 0).all()


def test_scores_misspellings_quotations_and_odd_texts(spark, toxic_model):
    docs, known, lexicon, weights, filler = toxic_model
    text = " ".join(filler[:20])
    long = " ".join(filler * 2500)
    rows = [
        (1, f"{text} vilewret {text} foulmouth"),
        (2, text),
        (3, f'{text} he said "you vilewret" and left'),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, long),
        (8, long + " vilewret foulmouth"),
        (9, "y" * 200_000),
        (9, f"{text} VILEWRET!"),
        (None, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS found")
    got = score(find_terms(frame, lexicon), weights).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id != 9}
    assert by_id[1].predicted == 1 and by_id[8].predicted == 1
    assert all(by_id[i].predicted == 0 for i in (2, 4, 5, 6, 7))
    assert by_id[3].score < by_id[1].score and by_id[3].found[0].quoted and not by_id[1].found[0].quoted
    assert by_id[4].score == by_id[5].score == by_id[None].score
    assert sorted(r.predicted for r in got if r.doc_id == 9) == [0, 1]
    assert by_id[8].found[0].at >= len(filler) * 2500
    misspelt = score(find_terms(spark.createDataFrame([(1, "a vilwret b")], "doc_id long, text string"), [Term("vilewret", False)]), weights)
    assert misspelt.first().found[0].edits == 1


def test_held_out_toxic_texts(spark, toxic_model):
    lexicon, weights = toxic_model[2:4]
    rows, labels, _ = toxic_corpus(random.Random(6), 100)
    got = score(find_terms(spark.createDataFrame(rows, "doc_id long, text string"), lexicon), weights).collect()
    truth = dict(labels)
    assert sum(r.predicted == truth[r.doc_id] for r in got) >= 98


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([(None, None), (1, None), (7, 1)], "doc_id long, toxic int")
    assert learn_lexicon(labelled_texts(docs, none)) == []
    found = find_terms(docs, [])
    weights = learn_weights(found, one_label(none))
    assert [(r.score, r.predicted) for r in score(found, weights).collect()] == [(0.5, 1)]
    assert score(find_terms(docs.limit(0), []), weights).collect() == []


# Prefix tries


def brute_trie(sequences):
    """All prefixes of (id, tuple of (role, text)), node by node."""
    members = {}
    for conv, seq in sequences:
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(conv)
    result = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted(c for c, s in sequences if s == prefix)
        childless = [p for p in below if not any(q[:-1] == p for q in members if q)]
        result.append((
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
            sum(q[:-1] == prefix for q in members if q), len(childless),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(result, key=str)


def turn_frame(spark, sequences):
    rows = [(c, t, role, text) for c, seq in sequences for t, (role, text) in enumerate(seq)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def nodes_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,parts", [(0, 1), (1, 3), (2, 7), (3, 24), (4, 60)])
def test_trie_of_random_conversations(spark, seed, parts):
    rng = random.Random(seed)
    turns = [("user", "é" * k) for k in range(3)] + [("assistant", "é")]
    sequences = [(i, tuple(rng.choices(turns, weights=(6, 2, 1, 1), k=rng.randint(1, 9)))) for i in range(120)]
    # A group of copies and a conversation that others continue.
    sequences += [(500 + i, sequences[0][1]) for i in range(40)] + [(900, (("user", ""),) * 30)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert nodes_of(prefix_trie(ordered_turns(turn_frame(spark, sequences)))) == brute_trie(sequences)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_turns(spark):
    rows = [
        (1, None, None, None), (1, 5, "user", "b"), (1, 5, "user", "b"), (2, 0, "", ""), (2, 1, "use", "rb"), (None, 0, "user", "x"),
        (3, 2, "user", "late"), (3, 1, "user", "z" * 5_000_000), (4, 7, "b", "x"), (4, 7, "a", "y"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "'x' AS steps", "1 AS depth", "2 AS parent")
    want = [
        (1, (("", ""), ("user", "b"), ("user", "b"))), (2, (("", ""), ("use", "rb"))),
        (3, (("user", "z" * 5_000_000), ("user", "late"))), (4, (("a", "y"), ("b", "x"))),
    ]
    assert nodes_of(prefix_trie(ordered_turns(frame))) == brute_trie(want)
    assert prefix_trie(ordered_turns(frame.limit(0))).collect() == []


def test_turnless_conversations(spark):
    frame = spark.createDataFrame([(1, []), (2, [])], "conv_id long, steps array<string>")
    ends = hashlib.sha256(b"1,2").hexdigest()
    assert nodes_of(prefix_trie(frame)) == [(1, 0, None, 2, 0, 1, 0, ends)]
    assert NO_ENDS == hashlib.sha256().hexdigest()


# Centroid clustering


def brute_clusters(rows, clusters, rounds, dim, seed=2):
    kept = [(i, [int(np.floor(256 * float(v))) for v in x]) for i, x in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:clusters]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    nearest = lambda x: min(range(len(centroids)), key=lambda j: (far(x, centroids[j]), j))
    for _ in range(rounds):
        own = [nearest(x) for _, x in kept]
        for j in set(own):
            mine = [x for (_, x), a in zip(kept, own, strict=True) if a == j]
            centroids[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    own = [nearest(x) for _, x in kept]
    distance = [far(x, centroids[a]) for (_, x), a in zip(kept, own, strict=True)]
    inertia = {a: sum(d for d, b in zip(distance, own, strict=True) if a == b) for a in own}
    digest = {a: hashlib.sha256(",".join(map(str, centroids[a])).encode()).hexdigest() for a in own}
    return sorted(((i, a, d, inertia[a], sum(distance), digest[a]) for (i, _), a, d in zip(kept, own, distance, strict=True)), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_clusters_of_random_vectors(spark, seed):
    rng = np.random.default_rng(seed)
    # Few different values: many ties, repeated vectors and empty clusters.
    rows = [(i // 2 if i % 7 == 0 else i, (rng.integers(-2, 3, 4) / 256 * (1 + 90 * (seed == 2))).tolist()) for i in range(150)]
    rows += [(None, [0.1, 0.2, 0.3, 0.4]), (None, [0.1, 0.2, 0.3, 0.4])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = cluster_report(frame, clusters=12, rounds=3, dim=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows, 12, 3, 4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [1.0, 2.0]), (8, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "7 AS cluster", "'d' AS distance", "1 AS x")
    got = cluster_report(frame, dim=2).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia) for r in got] == [(7, 0, 0, 0, 0)]
    assert cluster_report(frame.filter("vec_id < 7"), dim=2).collect() == []


def test_huge_components_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [1e30, 1.0]), (3, [-1e30, 0.0]), (4, [3e6, 1.0]), (5, [3e6, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, centroids = cluster(frame, clusters=3, rounds=4, dim=2)
    brute = {r[0]: r for r in brute_clusters(rows, 3, 4, 2)}
    for r in found.collect():
        d = brute[r.vec_id][2]
        assert (r.cluster, r.distance) == (brute[r.vec_id][1], d if d < 2**63 else None)
        assert hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest() == brute[r.vec_id][5]


def test_sign_of_zero_favours_the_smaller_number():
    points = list(itertools.product(range(-2, 3), repeat=2))
    bisectors = Bisectors([[0, 0], [2, 0], [0, 0], [0, 2]], 2)
    want = [min(range(4), key=lambda j: (sum((a - b) ** 2 for a, b in zip(p, bisectors.centroids[j], strict=True)), j)) for p in points]
    assert bisectors.nearest(np.array(points)).tolist() == want
