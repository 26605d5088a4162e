"""Near-duplicates, components, repeated lines, quality rules and fingerprints."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash

from llm_support import FOLDER, HAS_TABLES, docs, edge_frame, odd_texts, sentence, words_of
from vecspark.llm import line_dedup, merkle
from vecspark.llm.components import connected_components
from vecspark.llm.line_dedup import remove_repeated_lines
from vecspark.llm.near_dedup import keep_one, near_duplicates
from vecspark.llm.quality import filter_documents, host_verdicts, judge, measure


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    words = words_of(text)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute_components(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows]
    edges = [
        (a, b)
        for n, (a, x) in enumerate(sets)
        for b, y in sets[:n]
        if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    return components({i for i, _ in rows if i is not None}, edges)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    found = {r.node: r.component_id for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    assert found == {n: want[n] for e in edges if e[0] != e[1] for n in e}
    assert not connected_components(spark.createDataFrame([], "a long, b long")).collect()


def test_near_duplicates_agree_with_brute_force(spark):
    rng, rows = random.Random(2), []
    for _ in range(12):
        base = sentence(rng, rng.choice([3, 12, 40, 120])).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = sentence(rng, 1)
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    rng.shuffle(rows)
    for k in (4, 5):
        found = near_duplicates(docs(spark, rows), k=k).collect()
        want = brute_components(rows, k)
        assert {r.doc_id: r.component_id for r in found} == want
        assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, k)) for i, t in rows}
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    kept = {r.doc_id for r in keep_one(docs(spark, rows)).collect()}
    assert kept == set(brute_components(rows, 5).values())


def test_chain_across_a_bucket(spark):
    """Members that a bucket's smallest one isn't linked with still find each other."""
    words = [f"w{i}" for i in range(200)]
    far = words[:150] + [f"x{i}" for i in range(50)]
    rows = [(0, " ".join(words)), (1, " ".join(far)), (2, " ".join([*far[:-4], "y y", "z"]))]
    found = {r.doc_id: r.component_id for r in near_duplicates(docs(spark, rows), k=4).collect()}
    assert found == brute_components(rows, 4) == {0: 0, 1: 1, 2: 1}


def test_near_duplicates_edges(spark):
    frame = edge_frame(spark).withColumnRenamed("source", "component_id")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    found = near_duplicates(frame, k=4).collect()
    assert len(found) == len(rows)
    want = brute_components(rows, 4)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert not near_duplicates(frame.limit(0)).collect()
    with pytest.raises(ValueError):
        near_duplicates(frame, percent=50)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_units(lines, mean_lines):
    """Lines of each chunk, pair and single line."""
    h = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]

    def candidate(i):
        before = h[i - 2] if i > 1 else 0
        rolling = xxhash.xxh64_intdigest(h[i - 1].to_bytes(8, "little"), xxhash.xxh64_intdigest(before.to_bytes(8, "little"), 42))
        return i > 0 and signed(rolling) % mean_lines == 0

    starts = [i for i in range(len(lines)) if i == 0 or (candidate(i) and not candidate(i - 1))]
    full = [i for i, line in enumerate(lines) if words_of(line)]
    units = set(zip(starts, [*starts[1:], len(lines)]))
    units |= {(i, j + 1) for i, j in zip(full, full[1:])}
    return units | {(i, i + 1) for i in range(len(lines)) if len(words_of(lines[i])) >= 50}


def brute_line_dedup(rows, mean_lines=2, min_words=10, passage_words=50):
    def eligible(lines):
        n = sum(len(words_of(x)) for x in lines)
        return n >= passage_words or (n >= min_words and sum(bool(words_of(x)) for x in lines) >= 2)

    lines_of = {i: t.split("\n") for i, t in rows if t is not None}
    places = defaultdict(list)
    for i, lines in lines_of.items():
        for start, end in brute_units(lines, mean_lines):
            if eligible(lines[start:end]):
                places[tuple(lines[start:end])].append((i, start))
    removed = defaultdict(set)
    for unit, found in places.items():
        for i, start in set(found) - {min(found)}:
            removed[i].update(range(start, start + len(unit)))
    return {i: None if t is None else "\n".join(x for n, x in enumerate(lines_of[i]) if n not in removed[i]) for i, t in rows}


def repeated_pairs(texts):
    """Neighbouring lines of ten words together that stand together before; no chunks involved."""
    seen, again = set(), 0
    for text in texts:
        lines = (text or "").split("\n")
        for pair in zip(lines, lines[1:]):
            if all(map(words_of, pair)) and sum(len(words_of(x)) for x in pair) >= 10:
                again += pair in seen
                seen.add(pair)
    return again


def test_line_dedup_leaves_no_repeated_run(spark):
    rng = random.Random(11)
    runs = [[sentence(rng, rng.randint(5, 40)) for _ in range(n)] for n in (2, 2, 3, 3, 5, 9, 30)]
    rows = []
    for i in range(80):
        lines = [sentence(rng, rng.randint(0, 12)) for _ in range(rng.randint(2, 5))]
        for run in rng.sample(runs, rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = run
        rows.append((i, "\n".join(lines)))
    found = {r.doc_id: r.text for r in remove_repeated_lines(docs(spark, rows)).collect()}
    # Lines that only became neighbours when others went may be alike by chance.
    assert repeated_pairs(found[i] for i, _ in rows) <= 0.01 * repeated_pairs(t for _, t in rows)
    # All that goes is kept at its first place, and lines that stand nowhere else stay.
    before, after = ([line for t in texts for line in t.split("\n")] for texts in (dict(rows).values(), found.values()))
    assert set(before) - {""} == set(after) - {""}
    count = Counter(before)
    assert Counter(x for x in after if count[x] == 1) == Counter(x for x in before if count[x] == 1)


def test_line_dedup_agrees_with_brute_force(spark):
    rng = random.Random(3)
    passages = ["\n".join(sentence(rng, 15) for _ in range(6)), sentence(rng, 60), sentence(rng, 20) + "\n" + sentence(rng, 2)]
    rows = []
    for i in range(60):
        lines = [sentence(rng, rng.randint(0, 12)) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.6:
            lines.insert(rng.randint(0, len(lines)), rng.choice(passages))
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[3][1]), (101, ""), (102, None), (103, "\n\n")]
    found = remove_repeated_lines(docs(spark, rows), report=True).collect()
    assert {r.doc_id: r.text for r in found} == brute_line_dedup(rows)
    long = passages[1]
    assert sum(long in (r.text or "") for r in found) == 1  # a passage of 60 words stays once
    for r in found:
        if r.text is not None:
            source = dict(rows)[r.doc_id]
            assert Counter((r.text + "\n" + r.removed_text).split()) == Counter(source.split())
            assert r.n_lines == len(source.split("\n")) and r.n_removed_lines <= r.n_lines


def test_line_dedup_edges(spark):
    frame = edge_frame(spark)
    found = remove_repeated_lines(frame.withColumnRenamed("lang", "chunk_no").withColumnRenamed("source", "place"))
    assert found.columns == ["doc_id", "text", "chunk_no", "place", "n_chars"]
    assert found.count() == frame.count()
    rows = list(enumerate(odd_texts()))
    assert {r.doc_id: r.text for r in remove_repeated_lines(docs(spark, rows)).collect()} == brute_line_dedup(rows)
    twice = docs(spark, [rows[16], rows[16], (50, rows[16][1])])
    kept = [(r.doc_id, r.text) for r in remove_repeated_lines(twice).collect()]
    assert sorted(kept) == [rows[16], rows[16], (50, "")]
    assert not remove_repeated_lines(frame.limit(0)).collect()
    assert line_dedup.PASSAGE_WORDS == 50
    huge = "\n".join(["", "one line of ten words that both of these have", "\n" * 20_000, "w" * 200_000, sentence(random.Random(1), 3_000)])
    many = "\n".join(f"{n} is a line of its own" for n in range(30_000))
    long = [(1, huge), (2, many), (3, "x\n" + huge), (4, many + "\nend")]
    assert {r.doc_id: r.text for r in remove_repeated_lines(docs(spark, long)).collect()} == brute_line_dedup(long)


def brute_measures(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_agree_with_brute_force(spark):
    frame = edge_frame(spark).withColumnRenamed("lang", "n_words")
    found = measure(frame)
    assert found.count() == frame.count()
    for r in found.collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words)
        assert got == brute_measures(r.text), r.text
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 30)))) for i in range(200)]
    for r in measure(docs(spark, rows)).collect():
        assert r.n_repeat_words == brute_measures(r.text)[-1]


def test_hosts_are_shrunk_and_joined_back(spark):
    rng, rows = random.Random(5), []
    for host, n, bad in (("good", 60, 3), ("bad", 60, 57), ("one", 1, 1), (None, 30, 0)):
        rows += [(len(rows) + i, "x" if i < bad else sentence(rng, 20), "en", host) for i in range(n)]
    frame = docs(spark, rows)
    judged = judge(measure(frame))
    by_host = {r._host: r for r in host_verdicts(judged.withColumns({"symbols_failed": judged.base_failed, "lines_failed": judged.base_failed})).collect()}
    assert by_host["bad"].host_rejected and not by_host["good"].host_rejected and not by_host[None].host_rejected
    assert by_host["one"].base_failed_rate < 0.9  # one failure alone doesn't make a rate of 1
    kept = {r.doc_id for r in judged.filter("kept").collect()}
    want = {i for i, t, _, host in rows if host != "bad" and t != "x" and (host != "one")}
    assert kept == want
    assert {r.doc_id for r in filter_documents(frame).collect()} == want
    assert filter_documents(frame).columns == frame.columns
    assert not judge(measure(frame.limit(0))).collect()
    assert not filter_documents(frame.limit(0)).collect()


def test_symbols_reject_documents_unless_usual_for_their_host(spark):
    rng, rows = random.Random(8), []
    for host, n, bad in (("a", 400, 20), ("b", 400, 24), ("code", 60, 27), (None, 300, 9)):
        for i in range(n):
            text = sentence(rng, 20)
            rows.append((len(rows), text.replace(" ", "$$$ ") if i < bad else text, "en", host))
    frame = docs(spark, rows)
    want = {i for i, t, _, host in rows if "$" not in t or host == "code"}
    assert {r.doc_id for r in filter_documents(frame).collect()} == want
    judged = judge(measure(frame))
    assert {r.doc_id for r in judged.filter("kept").collect()} == want
    assert {r.source for r in judged.filter("symbols_excused").collect()} == {"code"}


@pytest.mark.skipif(not HAS_TABLES, reason="no supplied tables")
def test_labelled_good_documents_stay(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = judge(measure(frame)).join(labels, "doc_id")
    good, bad, by_symbols = "quality = 1", "quality = 0", "symbols_failed AND NOT base_failed"
    assert judged.filter(good).filter("NOT base_failed AND NOT kept").count() == 0
    assert judged.filter(bad).filter(by_symbols).count() == judged.filter(bad).filter(by_symbols).filter("NOT kept").count() > 0
    kept = filter_documents(frame).select("doc_id").join(labels, "doc_id")
    assert kept.count() == judged.filter("kept").count()


def test_fingerprints():
    rng = random.Random(6)
    text = "\n".join(sentence(rng, 12) for _ in range(20))
    lines = text.split("\n")
    edited = "\n".join([*lines[:7], "something else entirely", *lines[8:]])
    one, other = merkle.fingerprint(text), merkle.fingerprint(edited)
    assert merkle.fingerprint(text) == one != other
    assert 0.9 < merkle.likeness(one, other) < 1 == merkle.likeness(one, one)
    changed = merkle.changed_paragraphs(one, other)
    _, sections = merkle.parse(one)
    flat = [(i, k) for i, (_, ls) in enumerate(sections) for k in range(len(ls))]
    assert changed == [flat[7]]
    assert "".join(merkle.pieces_of(lines[0], 3)) == lines[0]
    assert merkle.likeness(merkle.fingerprint(""), one) == 0 and merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1
    assert merkle.likeness(merkle.fingerprint("a\nb"), merkle.fingerprint("b\na")) < 1


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, t), (_, following) in zip(order, [*order[1:], *order[:1]], strict=True):
        t, following = t or "", following or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        trees = [merkle.fingerprint(x) for x in (t, edited, following)]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), trees[0], trees[1], merkle.likeness(trees[0], trees[1]), merkle.likeness(trees[0], trees[2])))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 60])
def test_compared_with_next(spark, n):
    rng = random.Random(n)
    rows = [(rng.randint(-500, 500), sentence(rng, rng.randint(0, 30))) for _ in range(n)]
    rows = list(dict(rows).items())
    found = [tuple(r) for r in merkle.compare_with_next(docs(spark, rows).repartition(5), range_rows=4).collect()]
    assert sorted(found, key=str) == brute_next(rows)


def test_compared_with_next_edges(spark):
    frame = edge_frame(spark).withColumnRenamed("lang", "part")
    found = [tuple(r) for r in merkle.compare_with_next(frame, range_rows=3).collect()]
    want = brute_next([(r.doc_id, r.text) for r in frame.collect()])
    assert sorted(found, key=str) == want
    assert not merkle.compare_with_next(frame.limit(0)).collect()
    with_tree = merkle.add_fingerprint(frame)
    assert with_tree.columns == [*frame.columns, "fingerprint"] and with_tree.count() == frame.count()


@pytest.mark.skipif(not HAS_TABLES, reason="no supplied tables")
def test_plans_of_native_operators_have_no_python(spark):
    from tests_support import plan_of

    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for df in (judge(measure(frame)), filter_documents(frame), remove_repeated_lines(frame)):
        plan = plan_of(df)
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_documents_without_repeated_lines_are_told_apart(spark):
    rows = spark.createDataFrame([(i, str(i)) for i in range(4_000)], "doc_id long, text string")
    some = rows.filter("doc_id % 7 = 0 OR text IS NULL")
    found = line_dedup.may_hold(rows, line_dedup.holders(some, ["doc_id", "text"]), ["doc_id", "text"])
    assert found.columns == ["doc_id", "text", "_held"]
    held = [r.doc_id for r in found.filter("_held").collect()]
    assert set(range(0, 4_000, 7)) <= set(held) and len(held) < 600
    none = line_dedup.may_hold(rows, line_dedup.holders(rows.limit(0), ["doc_id"]), ["doc_id"])
    assert none.filter("_held").count() == 0 and none.count() == 4_000
