"""Control totals per account and sales week, kept up to date by a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from posloom.sources import commits as log

# Logs of the two writers, the stream and the compaction.
BATCHES, MERGES = "_batches", "_merges"
RECORD = "folder string, batch bigint, replaced array<string>"
BATCH = "_batch"

# Epoch day 0 was a Thursday; four days later a Monday-to-Sunday week begins.
WEEK_START = "4 days"


def weekly_totals(
    rows: DataFrame, time: str, account: str, amount: str, lateness: str | None = None
) -> DataFrame:
    """Works on batch and stream alike. Every week stays open, so a late sale
    counts whenever it comes (state: one row per account and week). Only a
    caller who names a ``lateness`` gives up rows later than that."""
    if rows.isStreaming and lateness:
        rows = rows.withWatermark(time, lateness)
    week = F.window(time, "7 days", startTime=WEEK_START)
    totals = rows.groupBy(week, F.col(account)).agg(
        F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("row_count")
    )
    return totals.select(
        F.date_add(F.col("window.start").cast("date"), 5).alias("week_ending"),
        account,
        "amount",
        "row_count",
    )


def keep_latest(totals: DataFrame, table_dir: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed totals to a folder of its own and commit it, then stop.

    A batch that is run again commits another folder in place of its first one,
    so nothing counts twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        folder = f"batch-{number}-{uuid.uuid4().hex}"
        batch.withColumn(BATCH, F.lit(number)).write.parquet(f"{table_dir}/{folder}")
        log.commit(batch.sparkSession, f"{table_dir}/{BATCHES}", {"folder": folder, "batch": number})

    return (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def snapshot(spark: SparkSession, table_dir: str) -> tuple[list[str], int]:
    """Folders of one version of the table, and the last batch they hold.

    That is the last merged folder with the batches committed after it. What is
    committed meanwhile changes no folder of a snapshot.
    """
    merged = log.read_commits(spark, f"{table_dir}/{MERGES}", RECORD).orderBy(F.desc("number")).first()
    upto = -1 if merged is None else merged["batch"]
    later = (
        log.read_commits(spark, f"{table_dir}/{BATCHES}", RECORD)
        .filter(F.col("batch") > upto)
        .groupBy("batch")
        .agg(F.max_by("folder", "number").alias("folder"))
        .collect()  # a row per batch since the last compaction
    )
    folders = [] if merged is None else [merged["folder"]]
    return folders + [r["folder"] for r in later], max([upto, *[r["batch"] for r in later]])


def _current(spark: SparkSession, table_dir: str, folders: list[str], keys: list[str]) -> DataFrame:
    table = spark.read.parquet(*[f"{table_dir}/{name}" for name in folders])
    values = [c for c in table.columns if c not in (*keys, BATCH)]
    last = F.max_by(F.struct(*values), BATCH).alias("last")
    return table.groupBy(*keys).agg(last, F.max(BATCH).alias(BATCH)).select(*keys, "last.*", BATCH)


def latest(spark: SparkSession, table_dir: str, keys: list[str]) -> DataFrame:
    """The totals of the last batch that touched each key."""
    return _current(spark, table_dir, snapshot(spark, table_dir)[0], keys).drop(BATCH)


def compact(spark: SparkSession, table_dir: str, keys: list[str]) -> None:
    """One folder of current totals in place of all that a snapshot holds.

    It may run beside the stream and beside readers: batches that come meanwhile
    stay as they are, and folders taken in are removed only by the compaction
    after the next commit of a merge. One compaction at a time.
    """
    folders, upto = snapshot(spark, table_dir)
    if len(folders) < 2:
        return
    known = log.read_commits(spark, f"{table_dir}/{MERGES}", RECORD)
    spent = {name for r in known.select("replaced").collect() for name in r["replaced"] or []}
    merged = f"merged-{upto}-{uuid.uuid4().hex}"
    _current(spark, table_dir, folders, keys).write.parquet(f"{table_dir}/{merged}")
    log.commit(spark, f"{table_dir}/{MERGES}", {"folder": merged, "batch": upto, "replaced": folders})
    for name in spent.intersection(log.names_in(spark, table_dir)):
        log.remove(spark, f"{table_dir}/{name}")
