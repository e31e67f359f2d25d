"""Helpers shared by the corpus operators: words, row keys, staged tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from posloom.session import shared_dir

# A gap between words, and a character of a word (ASCII white space only).
GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


class Scratch:
    """Tables one operator run stages in the folder that all executors share."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def stage(self, df: DataFrame) -> DataFrame:
        """Write a table and read it again: it is computed once and its lineage ends here."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def forget(self, df: DataFrame) -> None:
        """Remove a staged table that no later plan reads."""
        path = self.paths.pop(id(df))
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def row_keyed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with ``_file`` and ``_row``, two longs that name a stored row.

    They come from the file and the position in it, so every scan, and every
    repeated task, gives a row the same key. A frame that is no file scan is
    staged first. Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("_file", "_row")
    try:
        return docs.withColumns(_position())
    except AnalysisException:
        return scratch.stage(docs).withColumns(_position())


def wrapped(docs: DataFrame, scratch: Scratch, **columns: str) -> DataFrame:
    """Row-keyed ``doc``, a struct of the whole row, beside the named columns: no name in ``docs`` can clash."""
    named = [F.col(f"`{name}`").alias(own) for own, name in columns.items()]
    return row_keyed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *named), scratch)


def _position() -> dict[str, Column]:
    return {
        "_file": F.xxhash64(F.col("_metadata.file_path")),
        "_row": F.col("_metadata.row_index"),
    }


KEY = ["_file", "_row"]


def top_rows(df: DataFrame, score: str, limit: int, tie: str) -> list[Row]:
    """At most ``limit`` rows with the largest positive scores, in order.

    A histogram over steps of a ninth tells the score from which on the rows fit;
    only those come to the driver, however many tasks and rows there are. (A sort
    with a limit would send the driver ``limit`` rows from every task.)
    """
    step = F.floor(8 * F.log2(F.col(score).cast("double")))
    cut, room = None, limit
    for row in sorted(df.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        if row["count"] > room:
            break
        cut, room = row["step"], room - row["count"]
    if cut is None:
        return []
    found = df.filter(step >= cut).collect()
    return sorted(found, key=lambda r: (-r[score], r[tie]))
