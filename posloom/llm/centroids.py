"""Centroid clustering of vectors through their compressed cells (a VA-file).

Each vector is also stored as cells: per dimension the number, of a few bits, of
the equal-width cell that holds its component (exact bounds come from one pass).
A round looks at cells alone: a lookup table per dimension and centroid tells
what a cell can add to the distance at least and at most, and the sums are an
interval of distances to every centroid. The vector's own squared length is the
same for all centroids and is left out of both ends, which makes intervals
narrow. Where the lowest interval lies below all others the centroid is known;
otherwise the centroids whose intervals overlap it are kept with the row, the
full vector is fetched by a join, and only these are compared exactly.

Centroids are exact means, kept as sums and counts: a round adds and subtracts
the vectors that changed their cluster, so only these and the undecided ones are
fetched. Sums come to the driver combined: a number per cluster and dimension.
Cells, cluster and the vectors just fetched are staged each round, so a lost
executor costs a part of one round. The keys of fetched rows are broadcast only
if their measured size allows it.

Defined cases: rows that are not vectors of ``components`` finite numbers take
no part; of centroids at the same distance the smallest number wins; a null id
is clustered but starts no centroid; equal ids are vectors of their own, in
stored order; with fewer vectors than clusters there are fewer centroids; with
no centroid (all ids null) cluster and distance are null; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.llm.common import KEY, Scratch, read_table, row_keyed
from posloom.llm.hard_negatives import finite, scaled
from posloom.session import broadcast_limit

COMPONENTS = 64
CLUSTERS = 40
ROUNDS = 5
BITS = 6
SEED = "2:"
ROWS_AT_ONCE = 8192
FETCH_ROW_BYTES = 64  # of a fetched row's key, cells and candidates in a broadcast, without the cells
EXACT = 1 << 52  # whole numbers of a double
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


class Grid:
    """Cells of every dimension: ``origin + cell * width`` up to the next one's begin."""

    def __init__(self, least: list[int], most: list[int], bits: int = BITS):
        self.bits, self.cells = bits, 1 << bits
        self.least, self.most = [int(x) for x in least], [int(x) for x in most]
        self.width = [max(1, -(-(b - a + 1) // self.cells)) for a, b in zip(self.least, self.most)]
        reach = max([abs(x) for x in (*self.least, *self.most)], default=0)
        # Doubles hold all sums exactly, or Python's whole numbers do.
        self.kind = np.float64 if 8 * len(self.least) * reach * reach < EXACT else object

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        """A row of packed cells per vector, ``bits`` bits each."""
        whole = vectors.astype(object) if self.kind is object else vectors.astype(np.int64)
        cells = ((whole - np.asarray(self.least, whole.dtype)) // np.asarray(self.width, whole.dtype)).astype(np.uint8)
        bits = (cells[:, :, None] >> np.arange(self.bits, dtype=np.uint8)) & 1
        return np.packbits(bits.reshape(len(cells), len(self.least) * self.bits), axis=1, bitorder="little")

    def unpacked(self, packed: np.ndarray) -> np.ndarray:
        size = len(self.least)
        bits = np.unpackbits(packed, axis=1, bitorder="little")[:, : size * self.bits].reshape(len(packed), size, self.bits)
        return (bits << np.arange(self.bits, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)

    def tables(self, centroids: list[list[int]]) -> np.ndarray:
        """For a dimension and cell, least and most of c * c - 2 * x * c over the cell, for all centroids side by side."""
        c = np.asarray(centroids, self.kind).reshape(len(centroids), -1).T  # dimension, centroid
        out = np.empty((len(self.least), self.cells, 2 * len(centroids)), self.kind)
        for d in range(len(self.least)):
            low = np.asarray([min(self.least[d] + k * self.width[d], self.most[d]) for k in range(self.cells)], self.kind)
            high = np.asarray([min(self.least[d] + (k + 1) * self.width[d] - 1, self.most[d]) for k in range(self.cells)], self.kind)
            ends = [c[d] * c[d] - 2 * x[:, None] * c[d] for x in (low, high)]
            out[d] = np.concatenate([np.minimum(*ends), np.maximum(*ends)], axis=1)
        return out


def intervals(cells: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most of every centroid's distance, less the vector's squared length."""
    total = np.zeros((len(cells), tables.shape[2]), tables.dtype)
    for d in range(cells.shape[1]):
        total += tables[d][cells[:, d]]
    half = tables.shape[2] // 2
    return total[:, :half], total[:, half:]


def overlapping(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Centroids that may be the nearest one: those whose interval begins no later than the lowest one ends."""
    return low <= high.min(axis=1)[:, None]


def nearest(vectors: np.ndarray, centroids: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest allowed centroid (ties: the smaller number) and the squared distance."""
    best = np.full(len(vectors), -1, np.int32)
    least = np.zeros(len(vectors), vectors.dtype)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(allowed[:, k])
        gap = vectors[rows] - centroid
        far = (gap * gap).sum(axis=1)
        closer = (best[rows] < 0) | (far < least[rows])
        best[rows[closer]], least[rows[closer]] = k, far[closer]
    return best, least


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), size)


def _packed_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def with_cells(vectors: DataFrame, grid: Grid, size: int) -> DataFrame:
    """``vectors`` (id, key, vector) with their packed cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            packed = grid.cells_of(_matrix(part.column(3), size))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x.tobytes() for x in packed], pa.binary())], names=[*part.schema.names, "cells"])

    return vectors.select("id", *KEY, "vector").mapInArrow(run, vectors.select("id", *KEY, "vector").schema.add("cells", "binary"))


KEYS_SPEC = "_file long, _row long, cells binary, old int, new int"


class Rounds:
    """One run: the table of vectors with cells, and what a round does with it."""

    def __init__(self, base: DataFrame, grid: Grid, size: int, scratch: Scratch):
        self.base, self.grid, self.size, self.scratch = base, grid, size, scratch
        self.sums: dict[tuple[int, int], int] = defaultdict(int)

    def looked(self, state: DataFrame, centroids: list[list[int]]) -> DataFrame:
        """``state`` with the centroid its cells tell, or the ``open`` ones between which they do not; a vector stays."""
        grid = self.grid

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = grid.tables(centroids)
            for part in _parts(batches):
                allowed = overlapping(*intervals(grid.unpacked(_packed_matrix(part.column(2))), tables))
                known = allowed.sum(axis=1) == 1
                new = pa.array(allowed.argmax(axis=1), pa.int32(), mask=~known)
                open_ = pa.array([None if k else a.tobytes() for k, a in zip(known, allowed)], pa.binary())
                names = ["_file", "_row", "cells", "old", "new", "open", *part.schema.names[4:]]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], new, open_, *part.columns[4:]], names=names)

        return state.mapInArrow(run, f"{KEYS_SPEC}, open binary" + ", vector array<long>" * ("vector" in state.columns))

    def resolved(self, fetched: DataFrame, centroids: list[list[int]]) -> DataFrame:
        """Rows with their vectors: exact where cells left it open; the vector stays where the cluster changed."""
        grid, size = self.grid, self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            points = np.asarray(centroids, grid.kind)
            for part in _parts(batches):
                new = part.column(4).fill_null(-1).to_numpy().copy()
                rows = np.flatnonzero(new < 0)
                if len(rows):
                    some = part.take(pa.array(rows))
                    allowed = _packed_matrix(some.column(5)).astype(bool)
                    new[rows] = nearest(_matrix(some.column(6), size).astype(grid.kind), points, allowed)[0]
                moved = pa.array(new != part.column(3).to_numpy())
                vector = part.column(6).take(pa.array(np.arange(len(new)), mask=~np.asarray(moved)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array(new, pa.int32()), vector], names=["_file", "_row", "cells", "old", "new", "vector"]
                )

        return fetched.select("_file", "_row", "cells", "old", "new", "open", "vector").mapInArrow(run, f"{KEYS_SPEC}, vector array<long>")

    def turn(self, state: DataFrame | None, centroids: list[list[int]]) -> DataFrame:
        """A round: ``state`` (key, cells, old) to key, cells, old, new and the vectors that moved."""
        if state is None:  # all vectors move, so all are read beside their cells
            start = self.base.select(*KEY, "cells", F.lit(-1).alias("old"), "vector")
            return self.scratch.stage(self.resolved(self.looked(start, centroids), centroids))
        looked = self.scratch.stage(self.looked(state, centroids))
        wanted = F.col("new").isNull() | (F.col("new") != F.col("old"))
        needed = looked.filter(wanted)
        row_bytes = FETCH_ROW_BYTES + self.size * self.grid.bits // 8 + len(centroids)
        if needed.count() * row_bytes <= broadcast_limit(self.base.sparkSession):
            needed = F.broadcast(needed)
        fetched = self.resolved(needed.join(self.base.select(*KEY, "vector"), KEY), centroids)
        kept = looked.filter(~wanted).drop("open").withColumn("vector", F.lit(None).cast("array<long>"))
        out = self.scratch.stage(kept.unionByName(fetched))
        self.scratch.forget(looked)
        return out

    def add(self, met: DataFrame) -> None:
        """Take what moved into the sums; dimension -1 counts."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for part in _parts(batches):
                vectors = _matrix(part.column(2), size).astype(object)
                for sign, column in ((-1, 0), (1, 1)):
                    clusters = part.column(column).to_numpy()
                    for k in np.unique(clusters[clusters >= 0]).tolist():
                        mine = vectors[clusters == k]
                        have = sums.setdefault(k, np.zeros(size + 1, object))
                        have[:size] += sign * mine.sum(axis=0)
                        have[size] += sign * len(mine)
            rows = [(k, d if d < size else -1, Decimal(x)) for k, have in sums.items() for d, x in enumerate(have) if x]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.decimal128(38, 0))], names=["cluster", "d", "x"]
            )

        moved = met.filter("vector IS NOT NULL").select("old", "new", "vector")
        parts = moved.mapInArrow(run, "cluster int, d int, x decimal(38,0)")
        for row in parts.groupBy("cluster", "d").agg(F.sum("x").alias("x")).collect():  # a row per cluster and dimension
            self.sums[row["cluster"], row["d"]] += int(row["x"])

    def means(self, centroids: list[list[int]]) -> list[list[int]]:
        counts = [self.sums[k, -1] for k in range(len(centroids))]
        return [
            [self.sums[k, d] // n for d in range(self.size)] if n else centroid
            for k, (n, centroid) in enumerate(zip(counts, centroids))
        ]

    def last(self, centroids: list[list[int]]) -> DataFrame:
        """Cluster and exact distance of every vector: id, key, cluster, distance."""
        grid, size = self.grid, self.size
        types = self.base.select("id", *KEY).schema.add("cluster", "integer").add("distance", "long")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables, points = grid.tables(centroids), np.asarray(centroids, grid.kind)
            for part in _parts(batches):
                allowed = overlapping(*intervals(grid.unpacked(_packed_matrix(part.column(4))), tables))
                cluster, far = nearest(_matrix(part.column(3), size).astype(grid.kind), points, allowed)
                far = pa.array([min(int(x), MOST_LONG) for x in far], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(cluster), far], names=["id", *KEY, "cluster", "distance"])

        return self.base.select("id", *KEY, "vector", "cells").mapInArrow(run, types)


def clustered(
    vectors: DataFrame,
    scratch: Scratch,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    bits: int = BITS,
    size: int = COMPONENTS,
    seed: str = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """Id, key, cluster and distance of every vector (``id``, row key, ``vector`` of whole numbers), and the centroids."""
    vectors = scratch.stage(vectors.select("id", *KEY, "vector"))
    ends = vectors.agg(
        F.array(*[F.min(F.get("vector", d)) for d in range(size)]).alias("least"),
        F.array(*[F.max(F.get("vector", d)) for d in range(size)]).alias("most"),
    ).first()
    chance = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = vectors.filter("id IS NOT NULL").orderBy(chance, *KEY).limit(clusters).select("vector").collect()  # ``clusters`` rows
    centroids = [list(r["vector"]) for r in first]
    if not centroids:
        return vectors.select("id", *KEY, F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    grid = Grid(ends["least"], ends["most"], bits)
    base = scratch.stage(with_cells(vectors, grid, size))
    run, state = Rounds(base, grid, size, scratch), None
    for _ in range(rounds):
        met = run.turn(state, centroids)
        run.add(met)
        centroids = run.means(centroids)
        state = met.select(*KEY, "cells", F.col("new").alias("old"))
    return run.last(centroids), centroids


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    rows = row_keyed(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), scratch)
    fits = F.coalesce(F.size("embedding") == COMPONENTS, F.lit(False)) & finite(F.col("embedding"))
    vectors = rows.filter(fits).select(F.col("vec_id").alias("id"), *KEY, scaled(F.col("embedding")).alias("vector"))
    found, centroids = clustered(vectors, scratch)
    found = scratch.stage(found)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = {r["cluster"]: int(r["x"] or 0) for r in found.groupBy("cluster").agg(wide.alias("x")).collect()}  # a row per cluster
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame(
        [(k, min(per.get(k, 0), MOST_LONG), name) for k, name in enumerate(names)],
        "cluster int, cluster_inertia long, centroid_sha256 string",
    )
    whole = min(sum(per.values()), MOST_LONG)
    return found.join(F.broadcast(facts), "cluster", "left").select(  # a row per cluster
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256"
    )


def _round_sql(k: int) -> str:
    """Nearest centroid of every vector, then the means (or, of an empty one, the centroid as it was)."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, any_value(v.v) AS v, arg_min(cluster, d) AS cluster, (min(d) // 64)::BIGINT AS distance
  FROM (SELECT vec_id, v.v, cluster,
               64 * (list_inner_product(v.v, v.v) - 2 * list_inner_product(v.v, c) + list_inner_product(c, c))::BIGINT + cluster AS d
        FROM v CROSS JOIN c{k}) v
  GROUP BY vec_id
), c{k + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, o.c) AS c FROM c{k} o LEFT JOIN (
    SELECT cluster, list(x ORDER BY d) AS c FROM (
      SELECT cluster, d, floor(sum(x) / count(*)) AS x
      FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{k}) GROUP BY cluster, d)
    GROUP BY cluster) m USING (cluster)
)"""


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{SEED}' || vec_id)) - 1)::INTEGER AS cluster, v AS c FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('{SEED}' || vec_id)) <= {CLUSTERS}
),{",".join(_round_sql(k) for k in range(ROUNDS + 1))}
SELECT vec_id, a{ROUNDS}.cluster, distance,
       sum(distance) OVER (PARTITION BY a{ROUNDS}.cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)
"""
