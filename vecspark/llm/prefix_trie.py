"""The trie of all prefixes that conversations share, from sorted neighbours by union-find.

Every turn becomes a step of fixed width: a digest of role and text, and the size of the text.  A
conversation's key is its steps one after another, so that conversations with a common beginning
are neighbours once the keys are sorted.

* Equal keys are counted before anything is sorted, so a group of copies is one row.
* Distinct keys are sorted over range partitions.  A task takes the lengths of the longest common
  prefixes of neighbours in its partition as edges and joins them by union-find from the deepest
  on.  Each time two components merge, a branching node comes into being at that depth (or gains
  a child, if it is there already); the steps between two branching nodes are nodes with one child.
* Nodes that other partitions may share lie on prefixes of the partition's first or last key that
  also begin its neighbour's.  All other nodes are complete.  The partition forest is contracted
  to the open ones, whose figures are sums: members, children, leaves and savings are counted by
  the partition in which they begin.  A group-by over the digests of their prefixes merges them
  across all boundaries at once, and nodes below them are given their parent within the partition.
* The ids of conversations that end at a node are joined to strings of bounded size in sorted order
  in parallel, and one task a node only passes those strings to the hash, one at a time.

A task holds the lengths, counts and sizes of its partition's distinct conversations, not the keys.
A conversation's own steps, 24 bytes each, make one row.

Defined cases: turns without a number come first; turns of the same number go by role, then by the
digest of the text; null roles and texts are empty; repeated rows are turns of their own; rows
without a conversation are left out; an empty table gives an empty result; other columns are not
part of the result; texts of any length are hashed where they lie and never moved.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecspark.llm.batches import record_batch
from vecspark.sources.workspace import materialize

#: Bytes of a step: digest, then the size of the text.
_DIGEST, _STEP = 16, 24
#: Ids that are joined to one string, in bytes.
CHUNK_BYTES = 1 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()

_FOREST = pa.schema(
    [
        ("pid", pa.int32()),
        ("node", pa.string()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends", pa.string()),
        ("parent", pa.string()),
        ("parent_conv_id", pa.int64()),
    ]
)
_FOREST_DDL = (
    "pid int, node string, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, parent string, parent_conv_id long"
)


def ordered_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id`` and ``steps``, the turns of each conversation in order, as hexadecimal digits."""
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # The role's length keeps role and text apart.
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    step = F.concat(
        F.substring(F.sha2(whole, 256), 1, 2 * _DIGEST),
        F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * (_STEP - _DIGEST), "0"),
    )
    turns = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.struct(
            F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), step.alias("step")
        ).alias("t"),
    ).filter("conv_id IS NOT NULL")
    steps = F.transform(F.sort_array(F.collect_list("t")), lambda t: t["step"])
    return turns.groupBy("conv_id").agg(steps.alias("steps"))


def _common_steps(a: bytes, b: bytes) -> int:
    length = min(len(a), len(b))
    if a[:length] == b[:length]:
        return length // _STEP
    x, y = np.frombuffer(a, np.uint8, length), np.frombuffer(b, np.uint8, length)
    return int((x != y).argmax()) // _STEP


def _prefix_names(key: bytes, depth: int) -> list[str]:
    """Names of the nodes on a key from the root down to a depth."""
    state, names = hashlib.sha256(), []
    for d in range(depth + 1):
        names.append(state.hexdigest()[: 2 * _DIGEST])
        state.update(key[d * _STEP : (d + 1) * _STEP])
    return names


class _Partition:
    """Distinct keys of a range partition, in order, between the keys next to it."""

    def __init__(self, pid: int):
        self.pid = pid
        self.lengths: list[int] = []
        self.common: list[int] = []  # with the key before
        self.counts: list[int] = []
        self.ids: list[int] = []
        self.sizes: list[np.ndarray] = []
        self.names: list[str] = []
        self.before = self.after = -1  # steps in common with the neighbours; -1 without one
        self.first = self.last = b""
        self.previous: bytes | None = None

    def add(self, key: bytes, count: int | None, conv_id: int | None) -> None:
        shared = -1 if self.previous is None else _common_steps(self.previous, key)
        self.previous = key
        if count is None:  # a neighbour's key
            if self.lengths:
                self.after = shared
            return
        if not self.lengths:
            self.before, self.first = shared, key
        self.last = key
        self.common.append(shared)
        self.lengths.append(len(key) // _STEP)
        self.counts.append(count)
        self.ids.append(conv_id)
        self.sizes.append(np.frombuffer(key, ">u8").reshape(-1, _STEP // 8)[:, -1].astype(np.int64))
        self.names.append(hashlib.sha256(key).hexdigest()[: 2 * _DIGEST])

    def merge(self) -> tuple[list[int], list[int], list[list[int]]]:
        """Depth and leftmost key of each node and its children, by union-find over the edges.

        The first nodes are the keys' own; a node's children are deeper than it is.
        """
        total = len(self.lengths)
        depth, left = list(self.lengths), list(range(total))
        children: list[list[int]] = [[] for _ in range(total)]
        up, top = list(range(total)), list(range(total))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        edges = np.array(self.common[1:], np.int64)
        for edge in np.argsort(-edges, kind="stable").tolist():
            at = int(edges[edge])
            a, b = find(edge), find(edge + 1)
            node, other = top[a], top[b]
            if depth[node] != at:
                depth.append(at)
                left.append(left[node])
                children.append([node])
                node = len(depth) - 1
            children[node].append(other)
            # Interval neighbours: the left one's root stays, its node is the joint one.
            up[b] = a
            top[a] = node
        return depth, left, children

    def forest(self):
        """Batches of nodes; those that other partitions may share have a name."""
        total = len(self.lengths)
        depth, left, children = self.merge()
        order = sorted(range(len(depth)), key=depth.__getitem__, reverse=True)
        n, least, leaves, saved = ([0] * len(depth) for _ in range(4))
        right, parent = [0] * len(depth), [-1] * len(depth)
        for v, below in enumerate(children):
            for c in below:
                parent[c] = v
        following = [*self.common[1:], self.after]
        chains: list[tuple | None] = [None] * len(depth)
        for v in order:
            own = v < total
            n[v] = self.counts[v] if own else 0
            least[v] = self.ids[v] if own else 2**63 - 1
            leaves[v] = int(own and following[v] < depth[v])
            right[v] = v if own else left[v]
            kept, born = 0, 0
            for c in children[v]:
                n[v] += n[c]
                least[v] = min(least[v], least[c])
                leaves[v] += leaves[c]
                right[v] = max(right[v], right[c])
                kept += saved[c]
                born += not (left[c] == 0 and depth[v] + 1 <= self.before)
            # The chain of nodes up to the parent's depth, from the top down.
            above = depth[parent[v]] if parent[v] >= 0 else -1
            at = np.arange(above + 1, depth[v] + 1)
            begins = ~((left[v] == 0) & (at <= self.before))
            is_open = ~begins | ((right[v] == total - 1) & (at <= self.after))
            size = self.sizes[left[v]][np.maximum(at - 1, 0)] if depth[v] else np.zeros(len(at), np.int64)
            size = np.where(at == 0, 0, size)
            gain = (n[v] - begins.astype(np.int64)) * size
            below = kept + np.cumsum(gain[::-1])[::-1]
            saved[v] = int(below[0])
            chains[v] = (at, is_open, np.append(begins[1:].astype(np.int64), born), below)
        on_left = _prefix_names(self.first, max(self.before, 0))
        on_right = _prefix_names(self.last, max(self.after, 0))
        parts: dict[str, list] = {f.name: [] for f in _FOREST}
        for v in order:
            at, is_open, born, below = chains[v]
            count = len(at)
            names = on_left if left[v] == 0 else on_right
            if left[v] == 0 and right[v] == total - 1 and self.after > self.before:
                names = on_right
            above = parent[v]
            # An open node's parent is open; a complete one's may be.
            parent_open = np.append(False, is_open[:-1])
            parent_ids: list[int | None] = [least[v]] * count
            parent_names: list[str | None] = [names[d - 1] if o else None for d, o in zip(at.tolist(), parent_open, strict=True)]
            if above >= 0:
                if chains[above][1][-1]:
                    d = depth[above]
                    wide = left[above] == 0 and d <= self.before
                    parent_names[0] = (on_left if wide else on_right)[d]
                parent_ids[0] = least[above]
            else:
                parent_ids[0] = None  # the root
            parts["pid"] += [self.pid] * count
            parts["node"] += [names[d] if o else None for d, o in zip(at.tolist(), is_open.tolist(), strict=True)]
            parts["depth"] += at.tolist()
            parts["conv_id"] += [least[v]] * count
            parts["n_convs"] += [n[v]] * count
            parts["n_children"] += born.tolist()
            parts["n_leaves"] += [leaves[v]] * count
            parts["saved_tokens"] += below.tolist()
            parts["ends"] += [None] * (count - 1) + [self.names[v] if v < total else None]
            parts["parent"] += parent_names
            parts["parent_conv_id"] += [None if p is not None else i for p, i in zip(parent_names, parent_ids, strict=True)]
            if len(parts["pid"]) >= 20_000:
                yield record_batch(_FOREST, **parts)
                parts = {f.name: [] for f in _FOREST}
        if parts["pid"]:
            yield record_batch(_FOREST, **parts)


def _forests(batches):
    current: _Partition | None = None
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("pid", "key", "n", "conv_id"))
        for pid, key, count, conv_id in zip(*columns, strict=True):
            if current is None or current.pid != pid:
                if current is not None:
                    yield from current.forest()
                current = _Partition(pid)
            current.add(key, count, conv_id)
    if current is not None:
        yield from current.forest()


def _join_ids(batches):
    """Runs of a node's ids as strings of bounded size, in order."""
    schema = pa.schema([("ends", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
    now, ids, size = None, [], 0

    def chunk():
        return record_batch(schema, ends=[now], first=[ids[0]], ids=[",".join(map(str, ids))])

    for batch in batches:
        for ends, conv_id in zip(batch.column("ends").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (ends != now or size >= CHUNK_BYTES):
                yield chunk()
                ids, size = [], 0
            now = ends
            ids.append(conv_id)
            size += 20
    if ids:
        yield chunk()


def _hash_ids(batches):
    schema = pa.schema([("ends", pa.string()), ("ends_sha256", pa.string())])
    now, state = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple[str, str]] = []
        for ends, ids in zip(batch.column("ends").to_pylist(), batch.column("ids"), strict=True):
            if ends == now:
                state.update(b",")
            else:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = ends, hashlib.sha256()
            state.update(ids.as_py().encode())
        if done:
            yield record_batch(schema, ends=[d[0] for d in done], ends_sha256=[d[1] for d in done])
    if now is not None:
        yield record_batch(schema, ends=[now], ends_sha256=[state.hexdigest()])


def hash_ends(members: DataFrame) -> DataFrame:
    """``ends_sha256`` of the ``conv_id`` of each ``ends``, ascending and joined by commas."""
    runs = members.repartitionByRange("ends", "conv_id").sortWithinPartitions("ends", "conv_id")
    chunks = runs.select("ends", "conv_id").mapInArrow(_join_ids, "ends string, first long, ids string")
    return (
        chunks.repartition("ends")
        .sortWithinPartitions("ends", "first")
        .mapInArrow(_hash_ids, "ends string, ends_sha256 string")
    )


def _or_unlike(value: Column) -> Column:
    """The value, or where it is null a string that is like no other row's."""
    return F.coalesce(value, F.concat_ws("-", F.lit(""), F.col("pid"), F.col("conv_id"), F.col("depth")))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """A row per node of the trie over ``conv_id`` and ``steps`` (see ``ordered_turns``).

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's; then come ``depth``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    keys = sequences.select("conv_id", F.unhex(F.array_join("steps", "")).alias("key"))
    keys = materialize(keys, "keys")
    distinct = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    placed = distinct.repartitionByRange("key").sortWithinPartitions("key")
    placed = materialize(placed.select(F.spark_partition_id().alias("pid"), "key", "n", "conv_id"), "sorted-keys")

    # A row a partition, so that one task can tell which is next to which.
    bounds = placed.groupBy("pid").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    order = Window.orderBy("pid")
    bounds = bounds.select("pid", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    edge = bounds.select("pid", F.explode(F.array("before", "after")).alias("key")).filter("key IS NOT NULL")
    none = F.lit(None).cast("long")
    rows = placed.unionByName(edge.select("pid", "key", none.alias("n"), none.alias("conv_id")))
    forest = rows.repartition("pid").sortWithinPartitions("pid", "key").mapInArrow(_forests, _FOREST_DDL)
    forest = materialize(forest, "forest")

    partial = forest.filter("node IS NOT NULL")
    merged = materialize(
        partial.groupBy("node").agg(
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends").alias("ends"),
            F.max("parent").alias("parent"),
        ),
        "shared-nodes",
    )
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shared = merged.withColumn("pid", F.lit(-1)).join(names, "parent", "left")
    # What lies below a shared node finds it within its own partition, however many lie below.
    known = partial.select("pid", "node").join(merged.select("node", F.col("conv_id").alias("found")), "node")
    known = known.withColumnRenamed("node", "name")
    complete = forest.filter("node IS NULL").withColumn("name", _or_unlike(F.col("parent")))
    complete = complete.join(known, ["pid", "name"], "left")
    complete = complete.withColumn("parent_conv_id", F.coalesce("found", "parent_conv_id"))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = shared.select("pid", "ends", *columns).unionByName(complete.select("pid", "ends", *columns))
    members = keys.select(F.substring(F.sha2("key", 256), 1, 2 * _DIGEST).alias("ends"), "conv_id")
    hashes = hash_ends(members)
    nodes = nodes.withColumn("ends", _or_unlike(F.col("ends"))).join(hashes, "ends", "left")
    return nodes.select(*columns, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
