"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A document's set of word shingles gets a signature of 48 lanes of 16 bits (b-bit MinHash).  Sets
that are alike in 0.8 of their shingles differ in 9.6 lanes on average; 24 or more differ with a
chance of about one in a million.  Pairs that differ in up to 23 lanes are all found: of 12
chunks of 4 lanes one differs in a single lane at most (pigeonhole), so each chunk is indexed four
times, with each of its lanes left out.

* Documents with equal sets form a class; one stands for all.
* Shingles that only one member of all buckets has can't be shared.  Their number bounds what a
  document can have in common with any other, which proves of many edited copies that they are
  linked with nothing, or not with each other.
* Members of an index bucket are first compared with the one that has the fewest such shingles,
  most likely the original, which links large groups without pairs among their members.  Only
  members that end in different components are then compared with each other, each pair once,
  if their signatures and what is known of both allow it: two sets share at most what both share
  with the centre, and as much of the rest as the smaller rest is.
* Links are confirmed on the full sets of words, not on hashes.

Defined cases: null and blank texts have an empty set and are linked with nothing; a text of
fewer words than a shingle is one shingle; rows that share an id are one document, linked by what
any of them is linked by; a row without an id is linked with nothing and kept; an empty table
gives an empty result; result columns replace clashing ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.llm.batches import mix64, spans, text_slices, word_codes
from vecspark.llm.components import connected_components
from vecspark.sources.workspace import materialize

LANES = 48
LANES_IN_CHUNK = 4
CHUNKS = LANES // LANES_IN_CHUNK
#: Differing lanes up to which every pair is found: one error a chunk, and one chunk without.
MAX_DISTANCE = 2 * CHUNKS - 1
#: Alike in 80 of 100 shingles of the union.
PERCENT = 80

#: Bytes of a word that are hashed one by one.
_BYTEWISE = 24

_ODD = (np.random.default_rng(20240229).integers(0, 2**63, 2 * LANES, np.uint64) << np.uint64(1)) | np.uint64(1)
_FACTORS, _SHIFTS = _ODD[:LANES], _ODD[LANES:]


def lower_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    return word_codes(pc.ascii_lower(texts))


def _word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, the same in every task: byte by byte over all words together, and
    by blocks of eight bytes for what long words have beyond that."""
    data = pa.array(words, pa.large_string())
    size = pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(words).encode(), np.uint8)
    hashes = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first, last = spans(size)
    for k in range(min(int(size.max(initial=0)), _BYTEWISE)):
        live = np.flatnonzero(size > k)
        hashes[live] = mix64(hashes[live] ^ flat[first[live] + k].astype(np.uint64))
    for i in np.flatnonzero(size > _BYTEWISE).tolist():
        rest = flat[first[i] + _BYTEWISE : last[i]]
        blocks = np.zeros(-(-len(rest) // 8), "<u8")
        blocks.view(np.uint8)[: len(rest)] = rest
        place = mix64(np.arange(1, len(blocks) + 1, dtype=np.uint64))
        hashes[i] = mix64(hashes[i : i + 1] ^ mix64(blocks ^ place).sum(dtype=np.uint64))[0]
    return hashes


def shingle_hashes(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles per text, and their hashes in order."""
    per_text, codes, words = lower_words(texts)
    hashes = _word_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    first, last = spans(per_text)
    count = np.where(per_text >= k, per_text - k + 1, np.minimum(per_text, 1))
    text_no = np.repeat(np.arange(len(per_text)), count)
    begin = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[text_no]
    found = mix64(np.minimum(per_text, k)[text_no].astype(np.uint64))
    for i in range(k):
        at = begin + i
        inside = at < last[text_no]
        word = np.where(inside, hashes[np.minimum(at, max(len(hashes) - 1, 0))] if len(hashes) else 0, 0)
        found = mix64(found * np.uint64(0x9E3779B97F4A7C15) + word.astype(np.uint64))
    order = np.lexsort((found, text_no))
    found = found[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text_no[1:] != text_no[:-1])
    return np.bincount(text_no[fresh], minlength=len(per_text)), found[fresh]


def signatures(per_text: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Signature words, one row per text: each holds the lanes of one chunk."""
    words = np.zeros((len(per_text), CHUNKS), np.uint64)
    full = np.flatnonzero(per_text)
    first = spans(per_text)[0][full]
    if len(full):
        for lane in range(LANES):
            least = np.minimum.reduceat(shingles * _FACTORS[lane] + _SHIFTS[lane], first)
            bits = mix64(least) & np.uint64(0xFFFF)
            words[full, lane // LANES_IN_CHUNK] |= bits << np.uint64(16 * (lane % LANES_IN_CHUNK))
    return words


def sketch(documents: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, a 128-bit digest of the set, the signature."""
    source = documents.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    schema = source.select("doc_id").schema.add("n_shingles", "long").add("set_a", "long").add("set_b", "long")
    for chunk in range(CHUNKS):
        schema = schema.add(f"sig{chunk}", "long")

    def run(batches):
        for batch, texts in text_slices(batches, "text"):
            per_text, shingles = shingle_hashes(texts, k)
            digests = []
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                total = np.concatenate(
                    [np.zeros(1, np.uint64), np.cumsum(mix64(shingles ^ np.uint64(salt)), dtype=np.uint64)]
                )
                start, end = spans(per_text)
                digests.append((total[end] - total[start]).view(np.int64))
            words = signatures(per_text, shingles).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(per_text, pa.int64()),
                    *map(pa.array, digests),
                    *[pa.array(np.ascontiguousarray(words[:, c])) for c in range(CHUNKS)],
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", *[f"sig{c}" for c in range(CHUNKS)]],
            )

    return source.mapInArrow(run, schema)


def index_keys(classes: DataFrame) -> DataFrame:
    """``key``, ``tag`` and ``id``: every chunk of a signature with each of its lanes left out."""
    keys = []
    for chunk in range(CHUNKS):
        for lane in range(LANES_IN_CHUNK):
            mask = int(~np.int64(0xFFFF << (16 * lane) if lane < 3 else -1 << 48))
            kept = F.col(f"sig{chunk}").bitwiseAND(F.lit(mask))
            tag = F.lit(chunk * LANES_IN_CHUNK + lane)
            keys.append(F.struct(F.xxhash64(kept, tag).alias("key"), tag.alias("tag")))
    return classes.select(F.inline(F.array(*keys)), F.col("doc_id").alias("id"))


def _differing(a: str, b: str, chunk: int) -> Column:
    """The lowest bit of each lane of a chunk in which two signatures differ."""
    x = F.col(f"{a}.sig{chunk}").bitwiseXOR(F.col(f"{b}.sig{chunk}"))
    for shift in (8, 4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
    return x.bitwiseAND(F.lit(0x0001000100010001))


def distance(a: str, b: str) -> Column:
    """Differing lanes of two signatures."""
    total = F.lit(0)
    for chunk in range(CHUNKS):
        total = total + F.bit_count(_differing(a, b, chunk))
    return total


def first_tag(a: str, b: str) -> Column:
    """The first of the keys that two signatures share."""
    found = []
    for chunk in range(CHUNKS):
        lanes = _differing(a, b, chunk)
        # The single bit of a lane has sixteen bits below it for each lane before.
        lane = F.when(lanes == 0, F.lit(0)).otherwise((F.bit_count(lanes - 1) / 16).cast("int"))
        found.append(F.when(F.bit_count(lanes) <= 1, lane + chunk * LANES_IN_CHUNK))
    return F.coalesce(*found)


def may_be_alike(a: str, b: str, percent: int) -> Column:
    """Whether two sets can be alike, by their sizes and what they can share at most.

    ``shared`` is what a set has in common with any other; ``common``, where it is known, what
    it has in common with the centre of the bucket that both are in.
    """

    def of(name: str) -> tuple[Column, Column]:
        return F.col(f"{a}.{name}"), F.col(f"{b}.{name}")

    def rest(side: str) -> Column:
        return F.greatest(F.col(f"{side}.shared") - F.col(f"{side}.common"), F.lit(0))

    # Nulls are passed over by the outer least.
    by_centre = F.when(
        F.col(f"{a}.common").isNotNull() & F.col(f"{b}.common").isNotNull(),
        F.least(*of("common")) + F.least(rest(a), rest(b)),
    )
    shared = F.least(*of("shared"), by_centre)
    return 100 * shared >= percent * (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles") - shared)


def own_shingles(texts: DataFrame, k: int) -> DataFrame:
    """``id`` and ``own``, the number of shingles that no other id has."""

    def run(batches):
        for batch, of in text_slices(batches, "text"):
            per_text, shingles = shingle_hashes(of, k)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(per_text)), per_text)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(shingles.view(np.int64))], names=["id", "shingle"])

    found = texts.select(F.col("doc_id").alias("id"), "text")
    schema = found.select("id").schema.add("shingle", "long")
    holders = found.mapInArrow(run, schema).groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("last"))
    return holders.filter("id = last").groupBy("id").agg(F.count(F.lit(1)).alias("own"))


def _compare_sets(k: int):
    """What two texts have in common and in all, on the shingles themselves."""

    def shingles(text: str) -> set:
        words = text.encode().lower().split()
        if len(words) < k:
            return {tuple(words)} if words else set()
        return set(zip(*[words[i:] for i in range(k)], strict=False))

    def run(batches):
        known: dict[str, set] = {}
        for batch in batches:
            common, total = [], []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if a not in known:  # pairs with one text in common often follow each other
                    known = {a: shingles(a)}
                one, other = known[a], shingles(b)
                common.append(len(one & other))
                total.append(len(one) + len(other) - common[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                names=["a", "b", "common", "total"],
            )

    return run


def compare(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The pairs ``a``, ``b`` of ids with what their sets have in common and in all.
    ``texts`` has ``doc_id``, ``text``."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    schema = pairs.select("a", "b").schema.add("common", "long").add("total", "long")
    return both.mapInArrow(_compare_sets(k), schema)


def is_alike(percent: int) -> Column:
    return (F.col("total") > 0) & (100 * F.col("common") >= percent * F.col("total"))


def near_duplicates(
    documents: DataFrame,
    k: int = 5,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``.

    ``percent`` is the least similarity; below 80 the promise of the index does not hold.
    """
    if percent < PERCENT:
        raise ValueError(f"the index promises pairs alike in {PERCENT} percent or more")
    texts = documents.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    rows = materialize(sketch(documents, k, id_col, text_col), "sketches")
    linkable = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "set_a", "set_b"]
    signature = [f"sig{c}" for c in range(CHUNKS)]
    # Equal sets have equal signatures, so any of a class will do.
    classes = materialize(
        linkable.groupBy(*same).agg(
            F.min("doc_id").alias("doc_id"), *[F.min(s).alias(s) for s in signature]
        ),
        "classes",
    )
    members = (
        linkable.join(classes.select(*same, F.col("doc_id").alias("a")), same)
        .select("a", F.col("doc_id").alias("b"))
        .filter("a < b")
    )
    keys = index_keys(classes)
    buckets = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    crowded = materialize(
        keys.join(buckets.filter("low < high"), "key").select("key", "tag", "id"), "buckets"
    )
    ids = crowded.select(F.col("id").alias("doc_id")).distinct()
    texts = materialize(texts.join(ids, "doc_id", "left_semi"), "texts")
    # Two texts under one id have one number between them, which bounds neither.
    single = classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).filter("texts = 1")
    own = own_shingles(texts, k).join(single, F.col("id") == F.col("doc_id"), "left_semi")
    members_of = (
        classes.join(ids, "doc_id", "left_semi")
        .join(own.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .withColumn("shared", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
        .filter(100 * F.col("shared") >= percent * F.col("n_shingles"))
        .select("doc_id", "n_shingles", "shared", *signature)
    )
    linked = materialize(members_of, "members")

    # The centre of a bucket has the smallest part of shingles to itself.
    part = (1 - F.col("shared") / F.col("n_shingles")).alias("part")
    ranked = crowded.join(linked.select(F.col("doc_id").alias("id"), part).distinct(), "id")
    centres = materialize(
        ranked.groupBy("key").agg(F.min(F.struct("part", "id"))["id"].alias("centre")), "centres"
    )
    stars = ranked.join(centres, "key").filter("centre <> id")
    stars = stars.select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct()
    stars = (
        stars.join(linked.alias("x"), F.col("a") == F.col("x.doc_id"))
        .join(linked.alias("y"), F.col("b") == F.col("y.doc_id"))
        .filter(distance("x", "y") <= MAX_DISTANCE)
        .select("a", "b")
        .distinct()
    )
    stars = materialize(compare(stars, texts, k), "stars")
    confirmed = stars.filter(is_alike(percent)).select("a", "b")
    edges = materialize(confirmed.unionByName(members), "links")
    labels = connected_components(edges)
    # Buckets whose members are not all linked yet.
    labelled = (
        crowded.join(linked.select(F.col("doc_id").alias("id")).distinct(), "id")
        .join(labels, F.col("id") == F.col("node"), "left")
        .select("key", "tag", "id", F.coalesce("component_id", "id").alias("c"))
    )
    mixed = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    # Ids with several texts have several numbers, which say nothing.
    seen = stars.groupBy("a", "b").agg(F.max("common").alias("found"), F.count(F.lit(1)).alias("rows"))
    common = F.when(F.col("id") == F.col("centre"), F.col("n_shingles")).otherwise(F.col("found"))
    open_rows = (
        labelled.join(mixed.filter("low < high").select("key"), "key")
        .join(linked.withColumnRenamed("doc_id", "id"), "id")
        .join(centres, "key")
        .withColumns({"a": F.least("centre", "id"), "b": F.greatest("centre", "id")})
        .join(seen.filter("rows = 1").drop("rows"), ["a", "b"], "left")
        .withColumn("common", common)
    )
    open_rows = materialize(
        open_rows.select("key", "tag", "id", "c", "n_shingles", "shared", "common", *signature), "open"
    )
    one, other = open_rows.alias("x"), open_rows.alias("y")
    across = one.join(
        other,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.c") != F.col("y.c"))
        & may_be_alike("x", "y", percent)
        & (distance("x", "y") <= MAX_DISTANCE)
        & (F.col("x.tag") == first_tag("x", "y")),
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    fresh = across.distinct().join(stars.select("a", "b"), ["a", "b"], "left_anti")
    more = compare(fresh, texts, k).filter(is_alike(percent)).select("a", "b")
    more = materialize(more, "links")
    if not more.isEmpty():
        labels = connected_components(edges.unionByName(more))
    return rows.join(labels, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(
            F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)
        ).alias("kept"),
    )


def keep_one(documents: DataFrame, k: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near-duplicates, and all that are in none."""
    found = near_duplicates(documents, k, percent, id_col, text_col)
    gone = found.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, F.col(f"`{id_col}`") == F.col("_gone"), "left_anti")
