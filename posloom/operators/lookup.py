"""Left joins of a large feed to an item master of any size.

A master is reduced to its first row per key, measured once, and broadcast
only if the measured size is within the session's limit. Beyond that the feed
is split by key weight: keys that each hold over a thousandth of the feed (found
by a sketch, so at most a fixed number of keys, whatever the data) join their few
master rows by broadcast, the rest shuffles evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posloom.operators.dedup import first_per_key
from posloom.session import broadcast_limit

HEAVY_SHARE = 1000
HEAVY_KEYS = 2000  # no more keys can have an estimate over 1/HEAVY_SHARE of the rows
SKETCH_KEYS = 8192
SALTS = 4096
ROW_OVERHEAD_BYTES = 16
CELL_BYTES = 8


def measured_columns(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Rows of a dimension and the bytes of each column: one distributed aggregate, one row back."""
    sums = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("array", "map", "struct"):
            column = F.to_json(F.struct(column))
        text = F.octet_length(column) if kind in ("string", "array", "map", "struct") else F.lit(0)
        sums.append(F.coalesce(F.sum(text.cast("bigint")), F.lit(0)))
    rows, *found = df.agg(F.count(F.lit(1)), *sums).first()
    return rows, {name: CELL_BYTES * rows + n for name, n in zip(df.columns, found)}


def measured_bytes(df: DataFrame) -> int:
    """Size of a dimension in bytes."""
    rows, columns = measured_columns(df)
    return ROW_OVERHEAD_BYTES * rows + sum(columns.values())


def fits_broadcast(df: DataFrame, size: int | None = None) -> bool:
    size = measured_bytes(df) if size is None else size
    return size <= broadcast_limit(df.sparkSession)


def small_side(df: DataFrame, size: int | None) -> DataFrame:
    """``df`` marked for broadcast if the size measured earlier allows it, else as
    it is: a join whose side adaptive execution still sends to all tasks if it
    turns out small. Nothing is run here to find a size."""
    return F.broadcast(df) if size is not None and fits_broadcast(df, size) else df


def first_match(master: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The master with one row per key: the first by ``order``."""
    return first_per_key(master, [key], order)


def null_key_once(master: DataFrame, key: str, order: str = "master_row") -> DataFrame:
    """The master with every keyed row, but only the first row without a key.

    A plain merge in which NULL meets NULL then gives a feed row without key one
    partner, not each keyless master row: its result grows with the feed.
    """
    keyless = master.filter(F.col(key).isNull()).orderBy(order).limit(1)
    return master.filter(F.col(key).isNotNull()).unionByName(keyless)


def _condition(feed: DataFrame, dim: DataFrame, on: list[tuple[str, str]], null_safe: bool):
    pairs = [
        feed[f].eqNullSafe(dim[d]) if null_safe else feed[f] == dim[d] for f, d in on
    ]
    return reduce(lambda a, b: a & b, pairs)


def lookup(
    feed: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    null_safe: bool = False,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Left join to a dimension with at most one row per key.

    ``dim_bytes`` is the size measured earlier by the caller, if any. By
    default a NULL key matches nothing; with ``null_safe`` NULL meets NULL.
    """
    if fits_broadcast(dim, dim_bytes):
        return feed.join(F.broadcast(dim), _condition(feed, dim, on, null_safe), "left")
    return weighted_lookup(feed, dim, on, null_safe)


def weighted_lookup(
    feed: DataFrame, dim: DataFrame, on: list[tuple[str, str]], null_safe: bool = False
) -> DataFrame:
    """Left join to a dimension too large to broadcast, safe for heavy keys.

    The feed is read twice: once for a sketch of its heavy keys, once to be
    joined. Master rows of heavy keys go by broadcast. Feed rows that are done
    by then (or can match nothing) pass the shuffled join under a salt that no
    master row has, so they spread evenly. The master's side of a partition, one
    row per key, is hashed there: the feed is not sorted, so none of it spills.
    """
    feed_keys = [f for f, _ in on]
    numbered = range(len(on))
    heavy = F.broadcast(heavy_keys(feed, feed_keys))
    types = [feed.schema[f].dataType for f in feed_keys]
    dim_hash = F.xxhash64(*[F.col(d).cast(t) for (_, d), t in zip(on, types)])
    row = F.struct(*[F.col(f"`{c}`") for c in dim.columns])
    keyed = dim.select(*[F.col(d).alias(f"_dim_{i}") for i, (_, d) in enumerate(on)], row.alias("_row"), dim_hash.alias("_hash"))

    marked = feed.join(heavy, F.xxhash64(*feed_keys) == F.col("_heavy"), "left")
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in feed_keys])
    near = F.col("_heavy").isNotNull() if null_safe else F.col("_heavy").isNotNull() | keyless
    plain = [f.name for f in feed.schema.fields if f.dataType.typeName() != "map"]  # maps have no hash
    salt = F.when(near, 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(SALTS))).otherwise(0)

    def side(rows: DataFrame, name: str, *more: str) -> DataFrame:
        return rows.select(*[F.col(f"_dim_{i}").alias(f"{name}_{i}") for i in numbered], F.col("_row").alias(name), *more)

    def same(name: str) -> Column:
        pairs = [(F.col(f"`{f}`"), F.col(f"{name}_{i}")) for i, f in enumerate(feed_keys)]
        return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])

    near_dim = side(keyed.join(heavy, F.col("_hash") == F.col("_heavy"), "left_semi"), "_near")
    # Always 0, but not a literal: the salt stays a key of the shuffle.
    far_dim = side(keyed.withColumn("_zero", F.pmod("_hash", F.lit(1))), "_far", "_zero")
    closed = marked.withColumn("_salt", salt.cast("bigint")).join(F.broadcast(near_dim), same("_near"), "left")
    met = closed.join(far_dim.hint("shuffle_hash"), same("_far") & (F.col("_salt") == F.col("_zero")), "left")
    found = [F.coalesce(F.col(f"_near.`{c}`"), F.col(f"_far.`{c}`")).alias(c) for c in dim.columns]
    return met.select(*[F.col(f"`{c}`") for c in feed.columns], *found)


def heavy_keys(feed: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes (``_heavy``) of all keys that hold more than 1/HEAVY_SHARE of the rows.

    They come from a mergeable frequent-items sketch, one small state per task,
    so no table of all keys is shuffled. The sketch's error is at most 3.5 in
    SKETCH_KEYS of the rows: no heavy key is missing, and as many as HEAVY_KEYS
    keys have an estimate that large. A key that is a little lighter, or shares
    a hash, may be among them; only a few more master rows then travel.
    """
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(HEAVY_KEYS), F.lit(SKETCH_KEYS))
    return (
        feed.agg(top.alias("_top"), F.count(F.lit(1)).alias("_rows"))
        .select(F.explode("_top").alias("_key"), "_rows")
        .filter(F.col("_key.count") * HEAVY_SHARE > F.col("_rows"))
        .select(F.col("_key.item").alias("_heavy"))
    )


def fan_out_join(
    feed: DataFrame,
    master: DataFrame,
    on: list[tuple[str, str]],
    null_safe: bool = True,
    master_bytes: int | None = None,
) -> DataFrame:
    """Left join that keeps every master row of a key, as a plain merge does."""
    condition = _condition(feed, master, on, null_safe)
    return feed.join(small_side(master, master_bytes), condition, "left")
