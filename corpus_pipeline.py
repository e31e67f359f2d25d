"""The corpus pipeline: toxic texts go, copies go, sources are mixed, the rest is packed.

Each stage takes what its predecessor kept, and its table is written and read
again before the next. All but the last return the columns of ``documents``.
A stage on an empty table returns an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from posloom.llm.common import Scratch, read_table
from posloom.llm.exact_dedup import drop_exact
from posloom.llm.mixing import draw_mix
from posloom.llm.near_dedup import drop_near
from posloom.llm.packing import packed
from posloom.llm.toxicity import drop_toxic

MIX_SHARE = 0.9  # of the tokens that reach the mix
MIX_EPOCHS = 1  # no document is taken twice

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return draw_mix(docs, MIX_SHARE, MIX_EPOCHS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # learned scores, hashed signatures and bins have no SQL; tests/llm has brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, scratch.stage(stage(spark, docs, sf_dir))
        if k:
            scratch.forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
TWIN_SQL: dict[str, str] = {}
