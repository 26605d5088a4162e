"""Reuse of stored results: lookup by fingerprint and replay of time-to-live expiry."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions.times import micros
from vecspark.operators.merge import latest_per_key
from vecspark.sources.workspace import materialize

# Fixed value: seconds a stored result stays usable.
DEFAULT_TTL_SECONDS = 300

_NEVER = np.iinfo(np.int64).min
_ALWAYS = np.iinfo(np.int64).max


def reuse_results(
    requests: DataFrame,
    stored: DataFrame,
    key_col: str,
    ts_col: str,
    filled_col: str = "filled_at",
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
) -> DataFrame:
    """Requests with ``cache_hit``: the newest stored result of their key is still alive.

    A stored result lives from its fill (included) until the ttl has passed (excluded).
    """
    newest = latest_per_key(stored, [key_col], [filled_col])
    joined = requests.join(newest, key_col, "left")
    age = micros(joined, ts_col) - micros(joined, filled_col)
    alive = (age >= 0) & (age < ttl_seconds * 1_000_000)
    return joined.withColumn("cache_hit", F.coalesce(alive, F.lit(False)))


def to_compute(reused: DataFrame, key_col: str) -> DataFrame:
    """Each missing key once, with the number of requests waiting for it."""
    return (
        reused.filter(~F.col("cache_hit"))
        .groupBy(key_col)
        .agg(F.count(F.lit(1)).alias("waiting_requests"))
    )


def replay_ttl(
    requests: DataFrame,
    key_col: str,
    ts_col: str,
    id_col: str,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    hot_instants: int = 4096,
    chunk_ttls: int = 16,
    fan: int = 16,
) -> DataFrame:
    """Requests with ``cache_hit`` for a cache that each miss fills for ``ttl_seconds``.

    A hit does not extend the life of an entry, so each expiry depends on the previous miss.
    Requests of one key at one instant act as one: the lowest id is the miss.  A request
    without a key is always a miss.

    Keys with few instants are folded as arrays.  The time line of a hot key is cut into
    chunks of ``chunk_ttls`` lifetimes.  Each chunk yields a map from the expiry it is entered
    with to its last fill; ``fan`` neighbouring maps become one, again and again, until few
    are left; then the expiries are handed back down and each chunk replays its fills.  A map
    has one row per distinct instant of one lifetime at most, so no group holds more than
    ``chunk_ttls`` or ``fan`` lifetimes of one key, however many requests it has.
    """
    ttl = ttl_seconds * 1_000_000
    instants = materialize(
        requests.filter(F.col(key_col).isNotNull())
        .groupBy(F.col(key_col).alias("key"), micros(requests, ts_col).alias("us"))
        .agg(F.min(id_col).alias("id")),
        "instants",
    )
    sizes = instants.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # Written, so that Catalyst knows how short the list of hot keys is.
    hot_keys = materialize(sizes.filter(F.col("n") > hot_instants).select("key"), "hot-keys")
    fills = _fold_keys(instants.join(hot_keys, "key", "left_anti"), ttl)
    if not hot_keys.isEmpty():
        hot = instants.join(hot_keys, "key", "left_semi")
        fills = fills.unionByName(_replay_chunks(hot, ttl, chunk_ttls, fan))
    fills = fills.select(F.col("id").alias(id_col), F.lit(True).alias("_fill"))
    joined = requests.join(fills, id_col, "left")
    hit = F.col("_fill").isNull() & F.col(key_col).isNotNull()
    return joined.withColumn("cache_hit", hit).drop("_fill")


def _fold_keys(instants: DataFrame, ttl: int) -> DataFrame:
    """Fills of keys whose instants fit in one array."""
    row = "struct<us:bigint,id:" + instants.schema["id"].dataType.simpleString() + ">"
    start = F.struct(
        F.lit(_NEVER).alias("expiry"), F.array().cast(f"array<{row}>").alias("fills")
    )

    def step(state, instant):
        filled = F.struct(
            (instant["us"] + F.lit(ttl)).alias("expiry"),
            F.concat(state["fills"], F.array(instant)).alias("fills"),
        )
        return F.when(instant["us"] >= state["expiry"], filled).otherwise(state)

    ordered = F.array_sort(F.collect_list(F.struct("us", "id")))
    folded = F.aggregate(F.col("instants"), start, step, lambda state: state["fills"])
    return (
        instants.groupBy("key")
        .agg(ordered.alias("instants"))
        .select(F.explode(folded).alias("fill"))
        .select("fill.id")
    )


def _successors(us: np.ndarray, ttl: int) -> np.ndarray:
    """For a fill at each instant, the position of the next fill (len when there is none)."""
    return np.searchsorted(us, us + ttl, side="left")


def _runs(bounds: np.ndarray, fills: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge neighbouring entries with the same last fill; keep the upper bound of each run."""
    last = np.r_[fills[1:] != fills[:-1], True]
    return bounds[last], fills[last]


def _map_chunk(us: np.ndarray, start: int, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """Entered with expiry e, the last fill is that of the first run whose bound is >= e."""
    nxt = _successors(us, ttl)
    reach = np.where(nxt < len(us), nxt, np.arange(len(us)))
    while True:
        further = reach[reach]
        if np.array_equal(further, reach):
            break
        reach = further
    possible = min(len(us), int(np.searchsorted(us, start + ttl, side="left")) + 1)
    return _runs(us[:possible], us[reach][:possible])


def _walk(entry: np.ndarray, maps, ttl: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Expiries after passing the maps in order, and before each of them."""
    before = []
    for bounds, fills in maps:
        before.append(entry)
        at = np.searchsorted(bounds, entry, side="left")
        inside = at < len(bounds)
        entry = np.where(inside, fills[np.minimum(at, len(bounds) - 1)] + ttl, entry)
    return entry, before


def _maps_in_order(pdf: pd.DataFrame):
    positions, maps = [], []
    for position, part in pdf.sort_values(["position", "bound"]).groupby("position", sort=True):
        positions.append(position)
        maps.append((part["bound"].to_numpy(), part["fill"].to_numpy()))
    return positions, maps


def _chain(maps, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """One map for several consecutive chunks."""
    bounds, _ = maps[0]
    fills = _walk(bounds, maps, ttl)[0] - ttl
    if len(maps) > 1:
        # Entered too late for the first chunk: expired again before the second one starts.
        late = _walk(np.array([_NEVER]), maps[1:], ttl)[0] - ttl
        bounds, fills = np.r_[bounds, _ALWAYS], np.r_[fills, late]
    return _runs(bounds, fills)


def _replay_chunks(hot: DataFrame, ttl: int, chunk_ttls: int, fan: int) -> DataFrame:
    width = ttl * chunk_ttls
    chunked = hot.withColumn("position", F.expr(f"(us - pmod(us, {width}L)) div {width}L"))
    parent = F.floor(F.col("position") / F.lit(fan)).cast("bigint")
    key = T.StructField("key", hot.schema["key"].dataType)

    def schema(*names):
        return T.StructType([key, *[T.StructField(n, T.LongType()) for n in names]])

    def map_rows(pdf, position, bounds, fills):
        return pd.DataFrame(
            {"key": pdf["key"].iloc[0], "position": position, "bound": bounds, "fill": fills}
        )

    def map_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        position = int(pdf["position"].iloc[0])
        bounds, fills = _map_chunk(np.sort(pdf["us"].to_numpy()), position * width, ttl)
        return map_rows(pdf, position, bounds, fills)

    def join_maps(pdf: pd.DataFrame) -> pd.DataFrame:
        bounds, fills = _chain(_maps_in_order(pdf)[1], ttl)
        return map_rows(pdf, int(pdf["parent"].iloc[0]), bounds, fills)

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        start = pdf["entry"].iloc[0] if "entry" in pdf else _NEVER
        positions, maps = _maps_in_order(pdf)
        before = _walk(np.array([start], dtype=np.int64), maps, ttl)[1]
        return pd.DataFrame(
            {"key": pdf["key"].iloc[0], "position": positions, "entry": [int(e[0]) for e in before]}
        )

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("us")
        us, nxt = pdf["us"].to_numpy(), _successors(pdf["us"].to_numpy(), ttl)
        at, chosen = int(np.searchsorted(us, pdf["entry"].iloc[0], side="left")), []
        while at < len(us):
            chosen.append(at)
            at = int(nxt[at])
        return pdf.iloc[chosen][["id"]]

    map_schema, entry_schema = schema("position", "bound", "fill"), schema("position", "entry")
    first, last = chunked.agg(F.min("position"), F.max("position")).first()
    levels = [
        materialize(
            chunked.groupBy("key", "position").applyInPandas(map_chunk, map_schema), "ttl-maps"
        )
    ]
    while last - first >= fan:
        first, last = first // fan, last // fan
        grouped = levels[-1].withColumn("parent", parent).groupBy("key", "parent")
        levels.append(materialize(grouped.applyInPandas(join_maps, map_schema), "ttl-maps"))

    entries = levels[-1].groupBy("key").applyInPandas(enter, entry_schema)
    for maps in reversed(levels[:-1]):
        above = entries.withColumnRenamed("position", "parent")
        entries = (
            maps.withColumn("parent", parent)
            .join(above, ["key", "parent"])
            .groupBy("key", "parent")
            .applyInPandas(enter, entry_schema)
        )
    return (
        chunked.join(entries, ["key", "position"])
        .groupBy("key", "position")
        .applyInPandas(replay, T.StructType([hot.schema["id"]]))
    )
