"""The warehouse's item list over JDBC. The query and the connection come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    **options: str,
) -> DataFrame:
    """Rows of the caller's query; with ``split_on`` the range of that column is read in
    ``splits`` parallel pieces (rows outside ``bounds`` go to the end pieces)."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split_on is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("split_on needs bounds")
    return (
        reader.option("dbtable", f"({query}) items")
        .option("partitionColumn", split_on)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(splits))
        .load()
    )
