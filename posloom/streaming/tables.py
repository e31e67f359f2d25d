"""Tables written batch by batch, one folder per batch number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from posloom.sources.commits import names_in


def batch_numbers(spark: SparkSession, table_dir: str) -> list[int]:
    """Numbers of the batch folders present, in order."""
    names = names_in(spark, table_dir)
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def batches_before(
    spark: SparkSession, table_dir: str, number: float, schema: StructType
) -> DataFrame | None:
    """Rows of the batches before ``number``; None if there is none."""
    earlier = [n for n in batch_numbers(spark, table_dir) if n < number]
    if not earlier:
        return None
    return spark.read.schema(schema).parquet(*[f"{table_dir}/batch={n}" for n in earlier])
