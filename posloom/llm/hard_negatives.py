"""Hard negatives of anchors, by a vertical scan with bounds (BOND).

Rows are dealt at random to blocks of bounded size, each stored by dimension: a
column of numbers per dimension with its smallest and largest value. A block of
anchors meets every block of rows once; for an anchor the columns are read in
descending magnitude of its components. What the unread dimensions can still add
lies between the sums of their smallest and largest contributions, so after each
few columns a row is known to lie in an interval of scores. Rows that can no
longer matter leave the candidate bitmap, and the rest are read on until their
scores are exact:

* positives: rows of the anchor's label, other than itself. A row leaves if its
  largest score is under the smallest of ``positives`` rows before it.
* negatives: rows of another label. Each positive has a window of scores. A row
  leaves if its interval meets no window, or if ``negatives`` rows that surely
  lie in the window surely score more.

A block gives at most that many rows for each anchor (or positive); the best of
all blocks are taken by a window over these. Which rows are compared is the
stated set of anchors against all rows, in blocks; no table is broadcast.

Defined cases: rows with a null label or vector, or a null or non-finite
component, take no part; shorter vectors are filled up with zeros; a null id is
no anchor and comes last among ties; rows with equal ids are rows of their own,
in stored order; a positive whose window is empty (a negative score) has no
negatives; an anchor without positives gives no rows; scores stop at the range of
a long; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posloom.llm.common import KEY, Scratch, read_table, row_keyed

POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score
BLOCK_ROWS = 8192
ANCHOR_ROWS = 1024
STEP = 8  # columns read between two looks at the bitmap
EXACT = 1 << 52  # whole numbers of a double
MOST_LONG = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """True if a vector and all its components are there and finite."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def scaled(vector: Column, factor: int = 256) -> Column:
    """Whole numbers ``floor(factor * x)``."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def _packed(rows: DataFrame, block: str, *extra: str) -> DataFrame:
    """One row per block: a list of each field, and of each dimension the column with its two bounds."""
    fields = [f"{c}s array<{rows.schema[c].dataType.simpleString()}>" for c in ("id", *KEY, "label", *extra)]
    spec = ", ".join([f"{block} long", *fields, "columns array<binary>", "least array<long>", "most array<long>"])
    names = ["id", *KEY, "label", *extra]
    schema = _arrow(spec)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("id", *KEY)])  # nulls last: ties go by position
        vectors = table.column("vector").combine_chunks()
        size = max(1, int(np.diff(vectors.offsets.to_numpy()).max(initial=1)))
        grid = np.zeros((table.num_rows, size), np.int64)
        lengths = np.diff(vectors.offsets.to_numpy())
        grid[np.arange(size) < lengths[:, None]] = vectors.flatten().to_numpy()
        columns = [c.tobytes() for c in np.ascontiguousarray(grid.T)]
        row = [pa.array([table.column(block)[0].as_py()], pa.int64())]
        for name in names:
            values = table.column(name).combine_chunks()
            row.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
        row.append(pa.array([columns], pa.list_(pa.binary())))
        row += [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (grid.min(axis=0), grid.max(axis=0))]
        return pa.Table.from_arrays(row, names=schema.names).cast(schema)

    return rows.select(block, *names, "vector").groupBy(block).applyInArrow(pack, spec)


class Block:
    """A packed block in a task."""

    def __init__(self, table: pa.Table, *extra: str):
        row = table.slice(0, 1)
        field = lambda name: row.column(name).combine_chunks().flatten()
        self.fields = {n: field(f"{n}s") for n in ("id", *KEY, "label", *extra)}
        self.columns = np.stack([np.frombuffer(x.as_py(), np.int64) for x in field("columns")])
        self.least, self.most = (field(n).to_numpy() for n in ("least", "most"))
        self.key = np.stack([self.fields[k].to_numpy() for k in KEY])

    def labels(self) -> np.ndarray:
        return self.fields["label"].to_numpy(zero_copy_only=False)


def bounded_scan(rows: Block, query: np.ndarray, candidates: np.ndarray, keep: Callable, step: int = STEP):
    """Candidates that ``keep(lower, upper)`` never turned away, with their exact scores."""
    size = min(len(query), len(rows.columns))
    query = query[:size]
    order = np.argsort(-np.abs(query.astype(float)), kind="stable")
    ends = query * rows.least[:size].astype(query.dtype), query * rows.most[:size].astype(query.dtype)
    low, high = np.minimum(*ends), np.maximum(*ends)
    rest_low, rest_high = low.sum(), high.sum()
    scores = np.zeros(len(candidates), query.dtype)
    for at in range(0, size, step):
        some = order[at : at + step]
        scores = scores + query[some] @ rows.numbers[some][:, candidates]
        rest_low, rest_high = rest_low - low[some].sum(), rest_high - high[some].sum()
        stay = keep(scores + rest_low, scores + rest_high)
        candidates, scores = candidates[stay], scores[stay]
    return candidates, scores


def _kth(values: np.ndarray, k: int):
    """The k-th largest value, or None if there are fewer."""
    return None if len(values) < k else np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def _top(candidates: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The best k by score, then by position."""
    best = sorted(zip((-scores).tolist(), candidates.tolist()))[:k] if len(candidates) <= 8 * k else None
    if best is None:
        cut = _kth(scores, k)
        near = scores >= cut
        best = sorted(zip((-scores[near]).tolist(), candidates[near].tolist()))[:k]
    return [(place, -int(score)) for score, place in best]


def best_positives(rows: Block, query: np.ndarray, same: np.ndarray, k: int) -> list[tuple[int, int]]:
    def keep(lower, upper):
        cut = _kth(lower, k)
        return np.ones(len(lower), bool) if cut is None else upper >= min(cut, MOST_LONG)

    found, scores = bounded_scan(rows, query, same, keep)
    return _top(found, np.maximum(np.minimum(scores, MOST_LONG), -MOST_LONG), k)


def best_negatives(rows: Block, query: np.ndarray, others: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window of scores, the best k rows in it."""

    def keep(lower, upper):
        stay = np.zeros(len(lower), bool)
        for low, high in windows:
            meets = (upper >= low) & (lower <= high)
            cut = _kth(lower[(lower >= low) & (upper <= high)], k)
            stay |= meets if cut is None else meets & (upper >= cut)
        return stay

    found, scores = bounded_scan(rows, query, others, keep)
    return [_top(found[inside], scores[inside], k) for inside in ((scores >= a) & (scores <= b) for a, b in windows)]


def score_window(score: int, window: tuple[int, int] = WINDOW) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -(-window[0] * score // 100), window[1] * score // 100


def _numbers(anchors: Block, rows: Block) -> np.ndarray:
    """Anchors' vectors, and the block's columns set, in numbers that hold any score exactly."""
    size = min(len(anchors.columns), len(rows.columns))
    reach = [max(abs(int(a)), abs(int(b))) for block in (anchors, rows) for a, b in zip(block.least[:size], block.most[:size])]
    kind = np.float64 if sum(a * b for a, b in zip(reach[:size], reach[size:])) < EXACT else object
    rows.numbers = rows.columns.astype(kind)
    return anchors.columns.astype(kind).T


def _paired(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, row_blocks: int):
    """Each block of anchors beside each block of rows, as one small group."""
    left = anchors.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))))
    right = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_blocks - 1).cast("long"))))
    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block"))


def mined(
    vectors: DataFrame,
    scratch: Scratch,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """Triples of anchor, positive and ranked negative.

    ``vectors`` has ``id``, the row key, ``label``, ``vector`` (whole numbers)
    and ``anchor``, true for the rows to mine for.
    """
    rows = scratch.stage(vectors.select("id", *KEY, "label", "vector", "anchor"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).first()
    row_blocks, anchor_blocks = 1 + counts["n"] // block_rows, 1 + counts["anchors"] // anchor_rows
    dealt = F.xxhash64(F.lit(12), *KEY)
    blocks = scratch.stage(_packed(rows.withColumn("block", F.pmod(dealt, F.lit(row_blocks))), "block"))
    anchors = rows.filter("anchor").withColumn("part", F.pmod(dealt, F.lit(anchor_blocks)))
    id_type = rows.schema["id"].dataType.simpleString()
    found = f"anchor_id {id_type}, a_file long, a_row long, id {id_type}, _file long, _row long, score long"

    found_schema, negative_schema = _arrow(found), _arrow(f"{found}, nth long")

    def table(out: list[tuple], left: Block, right: Block, extra: list[str]) -> pa.Table:
        """Rows from (anchor place, row place, score, further numbers)."""
        a, b, *more = zip(*out) if out else ([], [], *[[]] * (1 + len(extra)))
        columns = []
        for block, places, names in ((left, a, ("anchor_id", "a_file", "a_row")), (right, b, ("id", *KEY))):
            columns += [(n, block.fields[f].take(pa.array(places, pa.int64()))) for f, n in zip(("id", *KEY), names)]
        columns += [(n, pa.array(v, pa.int64())) for n, v in zip(["score", *extra], more)]
        return pa.table(dict(columns))

    def positive_part(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return found_schema.empty_table()
        anchors_, rows_ = Block(left), Block(right)
        queries, labels, out = _numbers(anchors_, rows_), rows_.labels(), []
        for i, label in enumerate(anchors_.labels()):
            same = np.flatnonzero((labels == label) & ~(rows_.key == anchors_.key[:, i : i + 1]).all(axis=0))
            out += [(i, place, score) for place, score in best_positives(rows_, queries[i], same, positives)]
        return table(out, anchors_, rows_, [])

    met = _paired(_packed(anchors, "part"), blocks, anchor_blocks, row_blocks).applyInArrow(positive_part, found)
    best = W.partitionBy("a_file", "a_row").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), *KEY)
    chosen = met.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= positives)
    chosen = scratch.stage(chosen.drop("anchor_id"))
    windows = chosen.groupBy(F.col("a_file").alias(KEY[0]), F.col("a_row").alias(KEY[1])).agg(
        F.array_sort(F.collect_list(F.struct("nth", "score"))).alias("positives")
    )
    known = anchors.join(windows, KEY)

    def negative_part(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return negative_schema.empty_table()
        anchors_, rows_ = Block(left, "positives"), Block(right)
        queries, labels, out = _numbers(anchors_, rows_), rows_.labels(), []
        chosen_ = anchors_.fields["positives"].to_pylist()
        for i, label in enumerate(anchors_.labels()):
            others = np.flatnonzero(labels != label)
            ranges = [score_window(p["score"], window) for p in chosen_[i]]
            for p, part in zip(chosen_[i], best_negatives(rows_, queries[i], others, ranges, negatives)):
                out += [(i, place, score, p["nth"]) for place, score in part]
        return table(out, anchors_, rows_, ["nth"])

    pairs = _paired(_packed(known, "part", "positives"), blocks, anchor_blocks, row_blocks)
    met = pairs.applyInArrow(negative_part, f"{found}, nth long")
    best = W.partitionBy("a_file", "a_row", "nth").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), *KEY)
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    positive = chosen.select("a_file", "a_row", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(positive, ["a_file", "a_row", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _arrow(spec: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(spec))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    rows = row_keyed(read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), scratch)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.filter(F.col("label").isNotNull() & finite(F.col("embedding"))).select(
        F.col("vec_id").alias("id"),
        *KEY,
        label.alias("label"),
        scaled(F.col("embedding")).alias("vector"),
        F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)).alias("anchor"),
    )
    return mined(vectors, scratch)


OP12_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), p AS MATERIALIZED (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
