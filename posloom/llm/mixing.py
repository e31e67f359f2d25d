"""Mixing sources to target weights by hierarchical budgets.

Leaves of a tree domain > language > source hold documents. A token budget
flows from the root: each node splits it among its children by weight, and a
child that cannot use its share (its documents, read ``epochs`` times, hold
fewer tokens) leaves the rest to its siblings by their weights. A whole subtree
that falls short is such a child of its parent, so siblings are served before
the siblings of an ancestor. Within a leaf the documents are ordered anew in
each epoch by a seeded hash; whole epochs are taken, and of the last one the
prefix that reaches the budget.

The prefix is found without a window over a leaf: tokens are summed per leaf
and slice of the hash order, slices below the budget are taken and above it
left, and only the slice that holds the cut is ordered row by row. The number
of slices of a leaf follows its document count.

Defined cases: a null domain, language or source is a node of its own; a null
or empty text has no tokens and is taken only if the prefix passes it; weights
default to 1, a weight of 0 gets nothing; an empty table gives no rows; rows
that are equal are ordered by their stored position. Columns of any name are
returned with their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posloom.llm.common import KEY, Scratch, read_table, row_keyed, words_of, wrapped

LEVELS = ("domain", "lang", "source")
SEED = 7_321
SLICE_ROWS = 2_000

# Production weights: by node, keyed by level and the node's own value.
WEIGHTS: dict[str, dict[str, float]] = {
    "domain": {"0": 1.0, "1": 1.0, "2": 1.0, "3": 1.0},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "source": {},
}
EPOCHS = 3


def domain_of(source: Column) -> Column:
    """The last digits of a source modulo four; 'other' without digits."""
    digits = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d{1,9})$", 1)
    return F.when(digits == "", F.lit("other")).otherwise((digits.cast("long") % 4).cast("string"))


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(out)
    return out


def water_fill(children: DataFrame, parent: list[str], order: str) -> DataFrame:
    """Split the parent's ``budget`` among rows with ``cap`` and ``weight``.

    ``given = min(cap, level * weight)`` where the level uses up the budget. In
    the order of cap / weight the level is the largest of (budget - caps
    before) / weights from here on.
    """
    each = W.partitionBy(*parent).orderBy(F.col("_fill_at").asc_nulls_last(), order)
    before = F.coalesce(F.sum("cap").over(each.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(each.rowsBetween(W.currentRow, W.unboundedFollowing))
    level = F.max("_level").over(W.partitionBy(*parent))
    return (
        children.withColumn("_fill_at", F.try_divide("cap", "weight"))
        .withColumn("_level", F.try_divide(F.col("budget") - before, rest))
        .withColumn("given", F.greatest(F.lit(0.0), F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))))
        .drop("_fill_at", "_level")
    )


def budgets(leaves: DataFrame, total: Column, epochs: int, weights: dict[str, dict[str, float]] = WEIGHTS) -> DataFrame:
    """Leaf budgets; ``leaves`` has the levels and ``tokens``, one row per leaf."""
    nodes = leaves.withColumn("cap", F.col("tokens").cast("double") * epochs)
    given = None
    path: list[str] = []
    for level in LEVELS:
        path_now = [*path, level]
        children = nodes.groupBy(*path_now).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights))
        if given is not None:
            same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in path]
            joined = children.alias("c").join(given.alias("p"), same).select("c.*", F.col("p.given").alias("budget"))
        else:
            whole = W.partitionBy(F.lit(0))  # the nodes below the root
            joined = children.withColumn("budget", F.least(total.cast("double"), F.sum("cap").over(whole)))
        given = water_fill(joined, path or [F.lit(0)], level).select(*path_now, "given")
        path = path_now
    return given


def mixed(
    docs: DataFrame,
    share: float = 1.0,
    epochs: int = EPOCHS,
    weights: dict[str, dict[str, float]] = WEIGHTS,
    seed: int = SEED,
    id_col: str = "doc_id",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per document: id, row key, levels, tokens, times taken, leaf budget.

    The budget of the root is ``share`` of all tokens.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.stage(
        row_keyed(docs, scratch).select(
            F.col(id_col).alias("id"),
            *KEY,
            domain_of(F.col("source")).alias("domain"),
            F.col("lang").cast("string").alias("lang"),
            F.col("source").cast("string").alias("source"),
            F.size(words_of(F.col("text"))).cast("long").alias("tokens"),
        )
    )
    leaf_rows = scratch.stage(
        rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    )
    total = leaf_rows.agg(F.sum("tokens")).first()[0] or 0
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}")) for k in LEVELS]
    plan = scratch.stage(
        leaf_rows.alias("l")
        .join(budgets(leaf_rows, F.lit(float(total) * share), epochs, weights).alias("b"), same)
        .select("l.*", F.floor("b.given").alias("budget"))
        .withColumn("whole", F.coalesce(F.floor(F.try_divide("budget", "tokens")), F.lit(0)))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
        .withColumn("slices", F.greatest(F.lit(1), F.ceil(F.col("n") / slice_rows)))
    )
    # Documents meet their leaf's plan; one row per leaf, so a hot leaf's side is split by the skew join.
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in LEVELS]
    order = F.xxhash64(F.lit(seed), F.col("whole"), "id", *KEY)
    placed = scratch.stage(
        rows.alias("r")
        .join(plan.alias("p"), same)
        .select("r.*", "p.budget", "p.whole", "p.rest", "p.slices")
        .withColumn("at", order)
        # shiftright keeps the order of the hash, so slices follow each other
        .withColumn("slice", F.floor((F.shiftright("at", 32).cast("double") + 2**31) / 2**32 * F.col("slices")).cast("long"))
    )
    sums = placed.groupBy(*LEVELS, "slice").agg(F.sum("tokens").alias("slice_tokens"))
    before = W.partitionBy(*LEVELS).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("slice_before", F.coalesce(F.sum("slice_tokens").over(before), F.lit(0)))
    same = [F.col(f"x.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*LEVELS, "slice")]
    met = placed.alias("x").join(sums.alias("s"), same).select("x.*", "s.slice_tokens", "s.slice_before")
    inside = (F.col("slice_before") < F.col("rest")) & (F.col("slice_before") + F.col("slice_tokens") > F.col("rest"))
    settled = met.filter(~inside).withColumn("part", (F.col("slice_before") < F.col("rest")).cast("long"))
    running = F.sum("tokens").over(
        W.partitionBy(*LEVELS, "slice").orderBy("at", *KEY).rowsBetween(W.unboundedPreceding, -1)
    )
    cut = met.filter(inside).withColumn(
        "part", (F.col("slice_before") + F.coalesce(running, F.lit(0)) < F.col("rest")).cast("long")
    )
    return settled.unionByName(cut).select(
        F.col("id").alias(id_col), *KEY, *LEVELS, "tokens", (F.col("whole") + F.col("part")).alias("times"), "budget"
    )


def draw_mix(docs: DataFrame, share: float, epochs: int, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each time it is taken; columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    keyed = wrapped(docs, scratch, id="doc_id", text="text", lang="lang", source="source")
    taken = mixed(keyed.select("id", "text", "lang", "source"), share, epochs, id_col="id", **options).filter("times > 0")
    repeated = keyed.select("doc", *KEY).join(taken.select(*KEY, "times"), KEY)
    return repeated.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth")).select("doc.*")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *LEVELS, "tokens", "times", F.col("budget").alias("leaf_budget")
    )
