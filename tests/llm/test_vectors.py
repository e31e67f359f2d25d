"""Hard negatives and centroid clusters against plain Python."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from posloom.llm import centroids, hard_negatives
from posloom.llm.common import Scratch, row_keyed

SPEC = "vec_id long, embedding array<float>, label int, id string, vector string, anchor string, `block` string, cells string"


def table(spark, tmp_path_factory, rows, name):
    path = str(tmp_path_factory.mktemp(name) / "embeddings.parquet")
    spark.createDataFrame([(*r, *"xyzwv") for r in rows], SPEC).repartition(3).write.parquet(path)
    return path.removesuffix("/embeddings.parquet")


def edge_vectors(size=64):
    """Nulls, infinities, other lengths, ties, repeated rows and hot copies beside plain vectors."""
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(0, 0.15, size).round(3).tolist(), int(rng.integers(0, 4))) for k in range(220)]
    same = rng.normal(0, 0.15, size).round(2).tolist()
    rows += [(1000 + k, same, k % 2) for k in range(60)]
    rows += [(350, rows[3][1], 1), (350, rows[3][1], 1), (350, rows[4][1], 2), (None, rows[5][1], 1), (None, same, 2)]
    rows += [(400, None, 1), (401, [None, *rows[0][1][1:]], 1), (402, [math.nan] * size, 1), (450, [math.inf] * size, 1)]
    rows += [(403, rows[7][1], None), (500, [0.0] * size, 1), (501, [-x for x in rows[9][1]], 0)]
    return rows


def plain(rows):
    """Rows that take part: id, label, whole numbers."""
    out = []
    for vec, embedding, label in rows:
        if embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        out.append((vec, label, [math.floor(256 * float(np.float32(x))) for x in embedding]))
    return out


def brute_negatives(rows):
    known = []
    for n, (vec, label, v) in enumerate(plain(rows)):
        if label is not None:
            known.append((vec, (label + 1) % 10 if vec is not None and vec % 7 == 0 else label, v, n))
    size = max(len(r[2]) for r in known)
    grid = np.asarray([r[2] + [0] * (size - len(r[2])) for r in known], dtype=object)
    out = Counter()
    for i, (vec, label, v, _) in enumerate(known):
        if vec is None or vec % 50:
            continue
        scores = (grid @ grid[i]).tolist()
        order = sorted((j for j in range(len(known)) if j != i), key=lambda j: (-scores[j], known[j][0] is None, known[j][0] or 0))
        for p in [j for j in order if known[j][1] == label][:5]:
            found = [j for j in order if known[j][1] != label and 50 * scores[p] <= 100 * scores[j] <= 95 * scores[p]][:3]
            for rank, j in enumerate(found, 1):
                out[vec, known[p][0], rank, known[j][0], scores[p], scores[j]] += 1
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return table(spark, tmp_path_factory, edge_vectors(), "vectors")


@pytest.mark.parametrize("block_rows, anchor_rows", [(8192, 1024), (37, 2)])
def test_hard_negatives_equal_brute_force(spark, folder, block_rows, anchor_rows, monkeypatch):
    monkeypatch.setattr(hard_negatives.mined, "__defaults__", (5, 3, (50, 95), block_rows, anchor_rows))
    got = hard_negatives.op12_hard_negatives(spark, folder)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == brute_negatives(edge_vectors())


def test_hard_negatives_of_odd_tables(spark, tmp_path_factory):
    assert hard_negatives.op12_hard_negatives(spark, table(spark, tmp_path_factory, [], "none")).collect() == []
    odd = [(50, [1e30, 2.0], 1), (51, [1e30], 1), (52, [1e30, -1.0, 3.0], 2), (53, [], 2), (54, [0.5e30], 2), (100, [-1.0, 1.0], 1)]
    got = hard_negatives.op12_hard_negatives(spark, table(spark, tmp_path_factory, odd, "odd")).collect()
    assert got == []  # components and scores stop at the largest long, above any window
    close = [(50, [2e6, 2.0], 1), (51, [2e6], 1), (52, [1.8e6, 0.0], 2), (53, [1.99e6], 2)]
    got = hard_negatives.op12_hard_negatives(spark, table(spark, tmp_path_factory, close, "close")).collect()
    assert Counter(map(tuple, got)) == brute_negatives(close) and [r["negative_id"] for r in got] == [52]


def test_bounds_turn_rows_away_early():
    """Rows far off a window leave before all columns are read."""
    rng = np.random.default_rng(2)
    grid = rng.integers(-100, 100, (500, 32))
    grid[:, 0] = np.where(np.arange(500) < 5, 9000, -9000)

    class Rows:
        numbers, columns = np.ascontiguousarray(grid.T).astype(float), grid.T
        least, most = grid.min(axis=0), grid.max(axis=0)

    seen = []

    def keep(lower, upper):
        seen.append(len(lower))
        return upper >= np.partition(lower, -3)[-3]

    query = np.asarray([50.0, *rng.integers(-3, 3, 31)])
    places, scores = hard_negatives.bounded_scan(Rows, query, np.arange(500), keep)
    assert seen[0] == 500 and max(seen[1:]) <= 5
    assert (scores == grid[places] @ query).all()


def brute_clusters(rows, clusters=40, rounds=5, size=64):
    known = [(vec, v) for vec, _, v in plain(rows) if len(v) == size]
    grid = np.asarray([v for _, v in known], dtype=object).reshape(len(known), size)
    order = sorted((k for k in range(len(known)) if known[k][0] is not None), key=lambda k: hashlib.sha256(f"2:{known[k][0]}".encode()).hexdigest())
    points = [known[k][1] for k in order[:clusters]]
    for turn in range(rounds + 1):
        found = []
        for v in grid:
            gaps = [int(((v - np.asarray(c, object)) ** 2).sum()) for c in points]
            found.append((gaps.index(min(gaps)), min(gaps)))
        if turn < rounds:
            for k in range(len(points)):
                mine = grid[[c == k for c, _ in found]]
                if len(mine):
                    points[k] = [int(x) // len(mine) for x in mine.sum(axis=0)]
    per = defaultdict(int)
    for c, d in found:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in points]
    return Counter((known[k][0], c, d, per[c], sum(per.values()), sha[c]) for k, (c, d) in enumerate(found))


def cluster_rows(spark):
    rows = [r for r in edge_vectors() if r[0] is None or r[0] != 350]  # which of equal ids starts a centroid depends on storage
    return [*rows, (700, [0.1] * 63, 1), (701, [0.1] * 65, 1), (702, [], 0), (703, [3.0] * 64, 1), (704, [-2.0] * 64, None)]


def test_clusters_equal_brute_force(spark, tmp_path_factory):
    rows = cluster_rows(spark)
    got = centroids.op13_centroid_clusters(spark, table(spark, tmp_path_factory, rows, "clusters"))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_clusters(rows)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_cells_only_save_work(spark, tmp_path_factory, bits):
    rows = cluster_rows(spark)
    path = table(spark, tmp_path_factory, rows, f"bits{bits}")
    scratch = Scratch(spark)
    keyed = row_keyed(spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding"), scratch)
    fits = (F.size("embedding") == 64) & hard_negatives.finite(F.col("embedding"))
    vectors = keyed.filter(fits).select(F.col("vec_id").alias("id"), "_file", "_row", hard_negatives.scaled(F.col("embedding")).alias("vector"))
    found, _ = centroids.clustered(vectors, scratch, bits=bits)
    want = Counter((r[0], r[1], r[2]) for r, n in brute_clusters(rows).items() for _ in range(n))
    assert Counter((r["id"], r["cluster"], r["distance"]) for r in found.collect()) == want


def test_intervals_hold_the_distance():
    rng = np.random.default_rng(9)
    vectors = rng.integers(-300, 300, (400, 12))
    points = rng.integers(-300, 300, (7, 12)).tolist()
    for bits in (1, 2, 4, 6, 8):
        grid = centroids.Grid(vectors.min(axis=0).tolist(), vectors.max(axis=0).tolist(), bits)
        packed = grid.cells_of(vectors)
        assert packed.shape[1] == -(-12 * bits // 8)
        low, high = centroids.intervals(grid.unpacked(packed), grid.tables(points))
        true = ((vectors[:, None, :] - np.asarray(points)[None]) ** 2).sum(axis=2) - (vectors**2).sum(axis=1)[:, None]
        assert (low <= true).all() and (true <= high).all()
        allowed = centroids.overlapping(low, high)
        assert allowed[np.arange(400), true.argmin(axis=1)].all()


def test_clusters_of_odd_tables(spark, tmp_path_factory):
    assert centroids.op13_centroid_clusters(spark, table(spark, tmp_path_factory, [], "no_clusters")).collect() == []
    lost = [(None, [0.1] * 64, 1), (None, [0.2] * 64, 1)]
    got = centroids.op13_centroid_clusters(spark, table(spark, tmp_path_factory, lost, "lost")).collect()
    assert [(r["cluster"], r["distance"], r["centroid_sha256"]) for r in got] == [(None, None, None)] * 2
    wide = [(k, [(-1) ** k * 1e7 + k] * 64, 1) for k in range(50)]
    got = centroids.op13_centroid_clusters(spark, table(spark, tmp_path_factory, wide, "wide"))
    assert Counter(map(tuple, got.collect())) == brute_clusters(wide)
