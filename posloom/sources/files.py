"""Which file belongs to which account, and which one is the latest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.functions.text import name_has_token


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths, times and sizes; file contents are pruned and never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("modificationTime").alias("file_mtime"),
            "length",
        )
    )


def files_of_accounts(files: DataFrame, tokens: dict[str, str]) -> DataFrame:
    """Files with each account whose token stands in the normalised file name."""
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("account"), F.lit(t).alias("token"))
            for a, t in tokens.items()
        ]
    )
    return (
        files.select("*", F.inline(pairs))
        .filter(name_has_token(F.col("file_name"), F.col("token")))
        .drop("token")
    )


def latest_per_account(
    files: DataFrame, account: str = "account", path: str = "path", time: str = "file_mtime"
) -> DataFrame:
    """The newest file per account; of equally new ones the last by name."""
    return files.groupBy(account).agg(
        F.max_by(path, F.struct(time, path)).alias(path), F.max(time).alias(time)
    )


def newest(files: DataFrame, n: int, time: str = "file_mtime", path: str = "path") -> DataFrame:
    return files.orderBy(F.desc(time), path).limit(n)


def not_processed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger of finished loads does not hold yet."""
    keys = [c for c in ("path", "account") if c in files.columns and c in ledger.columns]
    return files.join(ledger.select(*keys).distinct(), keys, "left_anti")
