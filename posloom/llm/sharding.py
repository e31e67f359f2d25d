"""Uniform shuffle into shards of exact sizes, by a hypergeometric matrix.

Rows are dealt by hash into parts. How many rows of each part go to each shard
is drawn exactly, as a uniform permutation of all rows would send them
(multivariate hypergeometric, without replacement; by inversion, one law at every
size), so shard sizes are exact: at most one row apart. Each part permutes its rows by a seeded hash and cuts
that order by its row of the matrix; each shard permutes what it got again.

Only the matrix goes through the driver: one row of shard counts per part, and
a part holds ``PART_ROWS`` rows, so its size is rows / PART_ROWS x shards
numbers. No window ever holds more than about a part, because a shard is
permuted in blocks whose offsets come from counts.

Defined cases: null ids and repeated rows are rows like any other (the order
hashes the stored position), a null text has size 16 and the CRC of no bytes,
an empty table gives no rows; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posloom.llm.common import KEY, Scratch, read_table, row_keyed

SHARDS = 40
PART_ROWS = 500_000
MIN_PARTS = 16
SEED = 20_240_501


def _seeded(seed: int, step: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(step), *KEY)


def hypergeometric_law(room: int, others: int, need: int) -> tuple[int, np.ndarray]:
    """The least number considered and the weights of it and the numbers after it.

    Of ``need`` rows drawn without replacement from ``room + others``, so many are
    among the ``room``. Weights are products of the ratios of neighbours, from the
    most likely number outward, so no factorial of a large count is rounded. They
    end where the rest (by Bernstein's bound) is below what a double can tell.
    """
    pool = room + others
    low, high = max(0, need - others), min(room, need)
    mode = min(max((need + 1) * (room + 1) // (pool + 2), low), high)
    reach = math.ceil(12 * math.sqrt(need * (room / pool) * (others / pool))) + 60
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    ratio = (room - k) * (need - k) / ((k + 1) * (others - need + k + 1))  # of k + 1 to k
    at = mode - low
    below = np.cumprod(1 / ratio[:at][::-1])[::-1]
    return low, np.concatenate([below, [1.0], np.cumprod(ratio[at:])])


def _hypergeometric(rng: np.random.Generator, room: int, others: int, need: int) -> int:
    low, weights = hypergeometric_law(room, others, need)
    sums = np.cumsum(weights)
    return low + min(int(np.searchsorted(sums, rng.random() * sums[-1], side="right")), len(sums) - 1)


def communication_matrix(sizes: list[int], capacity: list[int], seed: int) -> np.ndarray:
    """Rows of part i that go to shard j; rows sum to ``sizes``, columns to ``capacity``."""
    rng = np.random.default_rng(seed)
    left = np.asarray(capacity, dtype=np.int64).copy()
    matrix = np.zeros((len(sizes), len(capacity)), dtype=np.int64)
    for i, size in enumerate(sizes):
        need, pool = int(size), int(left.sum())
        for j, room in enumerate(map(int, left)):
            others = pool - room
            if need == 0:
                break
            got = _hypergeometric(rng, room, others, need) if room else 0
            matrix[i, j] = got
            need -= got
            pool = others
        left -= matrix[i]
    return matrix


def assigned(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` (with row keys, already staged) with ``shard`` and ``slot``."""
    spark = rows.sparkSession
    total = rows.count()
    parts = max(MIN_PARTS, math.ceil(total / part_rows))
    parted = rows.withColumn("_part", F.pmod(_seeded(seed, 1), F.lit(parts)).cast("int"))
    counts = dict(parted.groupBy("_part").count().collect())
    sizes = [counts.get(p, 0) for p in range(parts)]
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix(sizes, capacity, seed)
    cuts = spark.createDataFrame(
        [(p, [int(c) for c in np.cumsum(matrix[p])]) for p in range(parts)], "_part int, _cuts array<bigint>"
    )
    local = W.partitionBy("_part").orderBy(_seeded(seed, 2), *KEY)
    dealt = (
        parted.withColumn("_rank", F.row_number().over(local))
        .join(cuts, "_part")
        .withColumn("shard", F.size(F.filter("_cuts", lambda c: c < F.col("_rank"))))
        .drop("_part", "_cuts", "_rank")
    )
    blocks = max(1, math.ceil(total / shards / part_rows))
    dealt = dealt.withColumn("_block", F.pmod(_seeded(seed, 3), F.lit(blocks)).cast("int"))
    before = W.partitionBy("shard").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "_block")
        .count()
        .select("shard", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    inner = W.partitionBy("shard", "_block").orderBy(_seeded(seed, 4), *KEY)
    return (
        dealt.join(offsets, ["shard", "_block"])
        .withColumn("slot", F.col("_offset") + F.row_number().over(inner) - 1)
        .drop("_block", "_offset")
    )


def into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``, laid out by shard and sorted by slot."""
    scratch = Scratch(docs.sparkSession)
    keyed = row_keyed(docs.drop("shard", "slot"), scratch)
    where = assigned(scratch.stage(keyed.select(*KEY)), shards, seed)
    return (
        keyed.join(where, KEY)
        .drop(*KEY)
        .repartitionByRange(F.col("shard"), F.col("slot"))
        .sortWithinPartitions("shard", "slot")
    )


def op8_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    text = F.coalesce("text", F.lit(""))
    rows = row_keyed(read_table(spark, sf_dir, "documents"), scratch).select(
        "doc_id",
        *KEY,
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return assigned(scratch.stage(rows)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
