"""Each account, week and file is let through once, however late a repeat comes.

The memory is a key store: the keys of all requests let through, dealt to folders
by their hash. A batch reads only the folders its own keys fall into, and only
what earlier batches put there, so its work follows the batch and not the
history. A batch that is run again reads the same and replaces its own files.
``compact_keys``, run between streams, merges the small files of each folder and
deals the keys to more folders once these hold ``PART_KEYS`` each on average.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from posloom.sources import commits as log
from posloom.streaming.tables import batches_before

PARTS = 64
PART_KEYS = 100_000
LAYOUT = "folder string, parts int"


def _part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _store(table_dir: str) -> str:
    return f"{table_dir}/_keys"


def layout(spark: SparkSession, table_dir: str) -> tuple[str, int] | None:
    """Folder of the current key store and the number of its hash folders."""
    found = log.read_commits(spark, f"{_store(table_dir)}/_commits", LAYOUT).orderBy(F.desc("number")).first()
    return None if found is None else (f"{_store(table_dir)}/{found['folder']}", found["parts"])


def prepare_store(spark: SparkSession, table_dir: str, keys: list[str], schema: StructType, parts: int = PARTS) -> None:
    """Make a key store if the table has none yet, from the batches it already holds."""
    if layout(spark, table_dir) is not None:
        return
    folder = f"layout-{uuid.uuid4().hex}"
    earlier = batches_before(spark, table_dir, float("inf"), schema)
    if earlier is not None:
        _put(earlier.select(*keys).distinct(), f"{_store(table_dir)}/{folder}", keys, parts, -1)
    log.commit(spark, f"{_store(table_dir)}/_commits", {"folder": folder, "parts": parts})


def _put(new: DataFrame, folder: str, keys: list[str], parts: int, number: int) -> None:
    dealt = new.select(*keys, _part(keys, parts).alias("part"), F.lit(number).alias("batch"))
    (
        dealt.repartition("part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part", "batch")
        .parquet(folder)
    )


def folders_to_read(spark: SparkSession, folder: str, touched: list[int], number: int) -> list[str]:
    """What batches before ``number`` put into the hash folders ``touched``."""
    out = []
    for part in touched:
        here = f"{folder}/part={part}"
        names = [n for n in log.names_in(spark, here) if n.startswith("batch=")]
        out += [f"{here}/{n}" for n in names if int(n.removeprefix("batch=")) < number]
    return out


def first_runs(runs: DataFrame, keys: list[str], seen: DataFrame | None) -> DataFrame:
    """The run requests of a batch whose keys ``seen`` does not hold, each key once."""
    new = runs.dropDuplicates(keys)
    if seen is None:
        return new
    known = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return new.join(known, same, "left_anti")


def keep_first_runs(runs: DataFrame, keys: list[str], table_dir: str, checkpoint: str) -> StreamingQuery:
    """Write the first request of each key under its batch number, then stop. Nothing expires."""
    schema = runs.schema
    key_schema = StructType([schema[k] for k in keys])
    prepare_store(runs.sparkSession, table_dir, keys, schema)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder, parts = layout(spark, table_dir)
        batch = batch.persist()
        touched = sorted(r[0] for r in batch.select(_part(keys, parts)).distinct().collect())  # at most ``parts``
        paths = folders_to_read(spark, folder, touched, number)
        seen = spark.read.schema(key_schema).parquet(*paths) if paths else None
        first_runs(batch, keys, seen).write.mode("overwrite").parquet(f"{table_dir}/batch={number}")
        _put(spark.read.schema(schema).parquet(f"{table_dir}/batch={number}"), folder, keys, parts, number)
        batch.unpersist()

    return (
        runs.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def compact_keys(spark: SparkSession, table_dir: str, keys: list[str], part_keys: int = PART_KEYS) -> None:
    """A new key store with one file a folder, and more folders if they are full. Run it between streams.

    The last batch stays by itself: if it is run again, it must not find its own keys.
    """
    found = layout(spark, table_dir)
    if found is None:
        return
    folder, parts = found
    if not any(n.startswith("part=") for n in log.names_in(spark, folder)):
        return
    store = spark.read.parquet(folder)
    counts = store.agg(F.count(F.lit(1)).alias("n"), F.max("batch").alias("last")).first()
    while counts["n"] > part_keys * parts:
        parts *= 2
    before = store.filter(F.col("batch") < counts["last"])
    fresh = f"layout-{uuid.uuid4().hex}"
    where = f"{_store(table_dir)}/{fresh}"
    _put(before, where, keys, parts, counts["last"] - 1)
    _put(store.filter(F.col("batch") == counts["last"]), where, keys, parts, counts["last"])
    log.commit(spark, f"{_store(table_dir)}/_commits", {"folder": fresh, "parts": parts})
    log.remove(spark, folder)
