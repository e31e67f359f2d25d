"""Packing documents into as few sequences as can be, by a configuration program.

Documents become token ids with an end id; longer ones are cut so that only the
first piece is short. The rest depends on the histogram of piece lengths alone
(at most one row per token of capacity, so it may pass through the driver):

1. Configuration linear program: how often to use each multiset of lengths that
   fits a sequence so that all lengths are covered, with the fewest sequences.
   Solved by multiplicative weights in small steps: a length weighs less the more
   of its pieces are covered; an unbounded knapsack over the capacity prices
   every length's best configuration at once, and those near the best price are
   each used a little more, so that no length gains more than ``STEP`` of its
   demand. The weights are a dual solution and bound the sequences from below.
   Steps end once the uses, scaled to cover everything, are within ``GAP`` of the
   best bound (or stop coming nearer, for histograms of a few pieces).
2. Rounding: whole uses first, then one more of the configurations with the
   largest uses, as long as pieces are left for them. What remains is placed by
   best fit, longest first, into the room that is left, in groups of equal
   sequences.

The result is a table of runs: ``count`` places for pieces of one length, in
following sequences, at one offset. A piece's rank among those of its length
picks its place. Ranks come from windows over salted lengths and counted
offsets, so a length that a third of all pieces have is no single task.

Defined cases: a null or empty text is one piece with the end id alone; repeated
rows are packed each; an empty table gives no rows; ids may be null.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posloom.llm.common import KEY, Scratch, read_table, row_keyed
from posloom.llm.tokens import VOCABULARY, slices, with_end, worker_encoder

CAPACITY = 2048
END_ID = 0
RANK_ROWS = 100_000
GAP = 0.06
STEP = 0.1
RATE = 20.0
NEAR = 0.02  # configurations within this share of the best price are used
STALE_ROUNDS = 100
TEXT_AT_ONCE = 4 << 20


def _pieces(vocabulary: str, capacity: int, schema: pa.Schema) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        for batch in batches:
            for part, texts in slices(batch, "_text", TEXT_AT_ONCE):
                ids, sizes = with_end(*encoder.encode(texts), END_ID)
                counts = -(-sizes // capacity)
                rows = np.repeat(np.arange(len(sizes)), counts)
                piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = sizes - capacity * (counts - 1)
                length = np.where(piece == 0, first[rows], capacity)
                start = np.where(piece == 0, 0, first[rows] + capacity * (piece - 1))
                begin = (np.cumsum(sizes) - sizes)[rows] + start
                view = memoryview(np.ascontiguousarray(ids)).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist())]
                keys = part.drop_columns(["_text"]).take(pa.array(rows, pa.int64()))
                columns = [pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, sums)]]
                yield pa.RecordBatch.from_arrays([*keys.columns, *columns], schema=schema)

    return run


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents (row-keyed): id, key, piece, start, length, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import IntegerType, LongType, StructType

    rows = docs.select(F.col(id_col).alias("id"), *KEY, F.col(text_col).alias("_text"))
    schema = StructType(rows.drop("_text").schema.fields).add("piece", IntegerType())
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, LongType())
    return rows.mapInArrow(_pieces(vocabulary, capacity, to_arrow_schema(schema)), schema)


Bins = list[tuple[tuple[int, ...], int]]  # lengths of a sequence, how many such sequences


class Prices:
    """Most valuable multisets of lengths for every room up to the capacity."""

    def __init__(self, lengths: np.ndarray, values: np.ndarray, capacity: int):
        self.lengths = lengths
        self.best = np.zeros(capacity + 1)
        self.pick = np.full(capacity + 1, -1)  # an item to take, or -1: as for one less room
        ends = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
        for room in range(1, capacity + 1):
            self.best[room] = self.best[room - 1]
            if ends[room]:
                gains = values[: ends[room]] + self.best[room - lengths[: ends[room]]]
                k = int(gains.argmax())
                if gains[k] > self.best[room]:
                    self.best[room], self.pick[room] = gains[k], k

    def items(self, room: int) -> list[int]:
        out = []
        while room > 0:
            k = int(self.pick[room])
            if k < 0:
                room -= 1
            else:
                out.append(k)
                room -= int(self.lengths[k])
        return out


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> list[int]:
    """Lengths (with repeats) of the most valuable multiset that fits."""
    return [int(lengths[k]) for k in Prices(lengths, values, capacity).items(capacity)]


def fractional(
    histogram: dict[int, int], capacity: int, gap: float = GAP
) -> tuple[dict[bytes, float], float, float]:
    """Uses of configurations that cover the histogram, a lower bound of sequences, and uses over bound.

    There may be some hundred thousand configurations, so each is kept as the
    bytes of its lengths (``array("I")``), ascending.
    """
    lengths = np.asarray(sorted(histogram))
    demand = np.asarray([histogram[x] for x in lengths], dtype=float)
    covered = np.zeros(len(lengths))  # as shares of the demand
    uses: dict[bytes, float] = defaultdict(float)
    size = lengths.tolist()
    bound, total, turn, ratio, earlier = float(lengths @ demand) / capacity, 0.0, 0, np.inf, np.inf
    while ratio > 1 + gap:
        values = np.exp(-RATE * (covered - covered.min())) * lengths / capacity
        prices = Prices(lengths, values, capacity)
        top = prices.best[capacity]
        bound = max(bound, float(values @ demand) / top)
        near = np.flatnonzero(values + prices.best[capacity - lengths] >= (1 - NEAR) * top)
        gained, shares = np.zeros(len(lengths)), []
        for k in near.tolist():
            config = tuple(sorted([k, *prices.items(capacity - int(lengths[k]))]))
            share = min(demand[i] / config.count(i) for i in set(config))
            shares.append((config, share))
            for i in config:
                gained[i] += share
        gained /= demand
        scale = STEP / gained.max()
        for config, share in shares:
            uses[array("I", [size[i] for i in config]).tobytes()] += scale * share
        total += scale * sum(share for _, share in shares)
        covered += scale * gained
        ratio = total / covered.min() / bound if covered.min() > 0 else np.inf
        turn += 1
        if turn % STALE_ROUNDS == 0:
            if ratio > 0.999 * earlier:
                break
            earlier = ratio
    least = covered.min()
    for config in uses:
        uses[config] /= least
    return uses, bound, ratio


def rounded(histogram: dict[int, int], uses: dict[bytes, float]) -> tuple[Bins, dict[int, int]]:
    """Whole uses within what is there, the largest first, and the pieces left."""
    left, bins = dict(histogram), []
    order = sorted(uses, key=lambda c: (-uses[c], c))
    for more in (False, True):
        for packed_ in order:
            config = array("I", packed_)
            need = {x: config.count(x) for x in set(config)}
            times = min(1 if more else int(uses[packed_]), *(left[x] // n for x, n in need.items()))
            if times > 0:
                for x, n in need.items():
                    left[x] -= n * times
                bins.append((tuple(sorted(config, reverse=True)), times))
    return bins, {x: n for x, n in left.items() if n}


def best_fit(left: dict[int, int], bins: Bins, capacity: int) -> Bins:
    """Place ``left`` (counts by length), longest first, where least room remains."""
    room: dict[int, list[list]] = defaultdict(list)
    for config, count in bins:
        room[capacity - sum(config)].append([config, count])
    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            fits = [r for r, groups in room.items() if r >= length and groups]
            if not fits:
                each = capacity // length
                whole, rest = divmod(need, each)
                if whole:
                    room[capacity - each * length].append([(length,) * each, whole])
                if rest:
                    room[capacity - rest * length].append([(length,) * rest, 1])
                break
            tight = min(fits)
            config, count = room[tight].pop()
            each = min(tight // length, need)
            used = min(count, need // each)
            if used < count:
                room[tight].append([config, count - used])
            room[tight - each * length].append([(*config, *[length] * each), used])
            need -= used * each
    return [(tuple(c), n) for groups in room.values() for c, n in groups]


@dataclass(frozen=True)
class Plan:
    """Bins with what the program says of them: no packing has fewer sequences than ``bound``."""

    bins: Bins
    bound: int
    ratio: float  # of the fractional solution to its bound
    pieces: int
    by_program: int  # pieces that the rounded program placed

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.bins)


def planned(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> Plan:
    full = histogram.get(capacity, 0)  # a sequence each
    rest = {x: n for x, n in histogram.items() if x < capacity}
    uses, bound, ratio = fractional(rest, capacity, gap) if rest else ({}, 0.0, 1.0)
    bins, left = rounded(rest, uses)
    placed = sum(rest.values()) - sum(left.values())
    bins = best_fit(left, bins, capacity)
    bins = [*([((capacity,), full)] if full else []), *bins]
    return Plan(bins, full + math.ceil(bound - 1e-6), ratio, full + sum(rest.values()), full + placed)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> Bins:
    return planned(histogram, capacity, gap).bins


def _places(bins: Bins) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence and offset of each run, ranks ascending."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    base = 0
    for config, count in bins:
        offset = 0
        for length in config:
            runs[length].append((count, base, offset))
            offset += length
        base += count
    out = {}
    for length, found in runs.items():
        counts, bases, offsets = (np.asarray(x, dtype=np.int64) for x in zip(*found))
        out[length] = (np.concatenate([[0], np.cumsum(counts)[:-1]]), bases, offsets)
    return out


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    gap: float = GAP,
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    keyed = row_keyed(docs.select(id_col, text_col), scratch)
    cut = scratch.stage(pieces(keyed, id_col, text_col, capacity, vocabulary))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # <= capacity rows
    places = spark.sparkContext.broadcast(_places(plan_bins(histogram, capacity, gap)))
    salts = spark.createDataFrame(
        [(x, 1 + n // RANK_ROWS) for x, n in histogram.items()], "length bigint, salts bigint"
    )
    salted = cut.join(F.broadcast(salts), "length").withColumn(
        "salt", F.pmod(F.xxhash64(*KEY, "piece"), F.col("salts"))
    )
    sums = salted.groupBy("length", "salt").count()
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    inner = W.partitionBy("length", "salt").orderBy(*KEY, "piece")
    ranked = (
        salted.withColumn("nth", F.row_number().over(inner) - 1)
        .join(sums, ["length", "salt"])
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("ahead") + F.col("nth")).alias("rank"))
    )

    def place(frames):
        table = places.value
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            for x in np.unique(length):
                mine = length == x
                first, bases, offsets = table[int(x)]
                run = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = bases[run] + rank[mine] - first[run]
                offset[mine] = offsets[run]
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInPandas(place, schema).withColumnRenamed("id", id_col)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))
