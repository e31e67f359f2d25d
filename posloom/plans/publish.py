"""The gate and the sinks. Only here, and in ``job``, do actions run.

Outcomes are computed once, into a staged table in the shared folder; every
sink reads that table. A lost executor costs the tasks it ran, not the lineage.

A run writes a version of its own into each sink and then names it in one
commit, together with the files that are done. Until then readers find what was
published before, from then on the new rows; nothing is removed in between, and
a run that stops anywhere can be repeated. ``read_published`` reads the sinks,
``vacuum`` removes versions that no reader is given any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.operators.control import control_totals
from posloom.operators.sets import append
from posloom.plans.engine import exception_rows
from posloom.schema import CANONICAL, EXCEPTION, FINAL
from posloom.session import shared_dir
from posloom.sources import commits as log

SINKS = {"tsv": "\t", "archive_csv": ",", "exceptions": ",", "validation": ","}  # and what separates their cells
PACKED = {"archive_csv"}  # kept, not handed on: gzip, which readers of the folder undo by the files' names


@dataclass(frozen=True)
class Sinks:
    """Folders of the four published tables, and of the commits that name their versions."""

    tsv: str
    archive_csv: str
    exceptions: str
    validation: str
    commits: str

    @classmethod
    def under(cls, folder: str, commits: str | None = None) -> Sinks:
        base = folder.rstrip("/")
        return cls(
            f"{base}/processed_tsv",
            f"{base}/archive_csv",
            f"{base}/exceptions",
            f"{base}/validation",
            commits or f"{base}/_commits",
        )

    def path(self, sink: str) -> str:
        return getattr(self, sink)


def failed_groups(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return rows.filter(F.col("outcome") == EXCEPTION).select(*by).distinct()


def gate(rows: DataFrame, by: tuple[str, ...] = ("AccountMajor",), few: bool = False) -> DataFrame:
    """Rows of the groups without a single exception.

    ``few`` groups, such as accounts and their files, are sent to all tasks: the
    rows are then not shuffled to meet them.
    """
    failed = failed_groups(rows, by)
    return rows.join(F.broadcast(failed) if few else failed, list(by), "left_anti")


def stage(df: DataFrame, spark: SparkSession, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut in the lineage."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, df: DataFrame) -> None:
    """Remove the folder of a staged table that nothing reads any more."""
    root = shared_dir(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in {unquote(f).partition(path(root).toUri().getPath() + "/")[2].partition("/")[0] for f in df.inputFiles()}:
        folder = path(f"{root}/{name}")
        if name:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


PARTITIONS = ("for_account", "for_file", "for_week")


FEW_GROUPS = 64  # open files of a task that writes rows as it reads them


@contextmanager
def open_files(spark: SparkSession, limit: int) -> Iterator[None]:
    """Writes keep a file open per folder instead of sorting, and sort only beyond ``limit`` folders a task."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_text(df: DataFrame, path: str, sep: str = ",", packed: bool = False, few: bool = False) -> None:
    """Headed text in a new folder, by account, file token and week.

    The partition columns are copies, so the files keep every column. The
    rebalance gives files of even size, however large one account is, and keeps
    a folder's rows in few files. With ``few`` folders each task writes the rows
    it reads: they are neither shuffled nor sorted.
    """
    with open_files(df.sparkSession, FEW_GROUPS) if few else nullcontext():
        (
            (df if few else df.hint("rebalance", *PARTITIONS))
            .write.partitionBy(*PARTITIONS)
            .option("sep", sep)
            .option("header", True)
            .option("emptyValue", "")
            .option("compression", "gzip" if packed else "none")
            .csv(path)
        )


def _partition_columns() -> dict:
    return {
        "for_account": F.lower("AccountMajor"),
        "for_file": F.coalesce("token", F.lower("AccountMajor")),
        "for_week": F.coalesce(F.col("WeekEnding").cast("string"), F.lit("none")),
    }


def with_tokens(rows: DataFrame, files: DataFrame | None) -> DataFrame:
    """Outcomes with the token of the file they came from; null without a file list.

    The file list has one row per file token of the run.
    """
    if files is None or "src_file" not in rows.columns:
        return rows.withColumn("token", F.lit(None).cast("string"))
    named = files.select(F.col("path").alias("_path"), F.col("account").alias("_token"), F.col("major").alias("_major"))
    same = (F.col("src_file") == F.col("_path")) & (F.col("AccountMajor") == F.col("_major"))
    return rows.join(F.broadcast(named), same, "left").withColumn("token", F.col("_token")).drop("_path", "_token", "_major")


def stage_outcomes(spark: SparkSession, rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Outcomes staged as the sinks read them, with tokens and partition columns."""
    named = with_tokens(rows, files).withColumns(_partition_columns())
    return stage(named, spark, "outcomes", ("AccountMajor", "outcome"))


RECORD = (
    "version string, groups array<array<string>>, done array<array<string>>, "
    "columns map<string, array<string>>"
)


def publish(
    spark: SparkSession, rows: DataFrame, sinks: Sinks, files: DataFrame | None = None, staged: bool = False
) -> DataFrame:
    """Write outcomes of any number of accounts; returns the staged rows.

    Rows of ``stage_outcomes`` are ``staged``: they are not staged once more.

    Each account and file token is judged by itself: with exceptions it gets
    only its exceptions written, without it gets its rows (tab separated, and
    the CSV archive) and control totals. The commit takes the place of what
    earlier runs published for the same account, token and week in all four
    sinks, so a file that now fails is no longer published, and exceptions that
    are mended are gone. It also notes the files without exceptions as done.
    """
    if not staged:
        rows = stage_outcomes(spark, rows, files)
    by = ("for_account", "for_file")
    passed = gate(rows, by, few=True).filter(F.col("outcome") == FINAL)
    clean = passed.select(*CANONICAL, *PARTITIONS)
    failed = rows.filter(F.col("outcome") == EXCEPTION)
    parts = {
        "tsv": clean,
        "archive_csv": clean,
        "exceptions": failed.select(*exception_rows(rows).columns, *PARTITIONS),
        "validation": control_totals(passed, ("AccountMajor", "WeekEnding", *PARTITIONS)),
    }
    version = f"v{uuid.uuid4().hex}"
    groups = [list(r) for r in rows.select(*PARTITIONS).distinct().collect()]  # one per file and week
    for sink, part in parts.items():
        write_text(part, f"{sinks.path(sink)}/version={version}", SINKS[sink], sink in PACKED, len(groups) <= FEW_GROUPS)
    done = [] if files is None else [list(r) for r in processed(files, rows).collect()]  # one per file of the run
    columns = {sink: [c for c in part.columns if c not in PARTITIONS] for sink, part in parts.items()}
    log.commit(spark, sinks.commits, {"version": version, "groups": groups, "done": done, "columns": columns})
    return rows


def live_groups(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """The version each published account, token and week is read from."""
    found = log.read_commits(spark, sinks.commits, RECORD).select("number", "version", F.explode("groups").alias("g"))
    keys = [F.col("g")[i].alias(name) for i, name in enumerate(PARTITIONS)]
    return found.groupBy(*keys).agg(F.max_by("version", "number").alias("version"))


def read_published(spark: SparkSession, sinks: Sinks, sink: str) -> DataFrame:
    """A sink's rows as last committed, all cells as text, with the partition columns."""
    live = live_groups(spark, sinks)
    wanted = live.select("version").distinct()
    written = log.read_commits(spark, sinks.commits, RECORD).join(wanted, "version", "left_semi")
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in written.select("version", "columns").collect():  # one per run that is still read from
        layouts.setdefault(tuple(row["columns"][sink]), []).append(row["version"])
    parts = []
    for names, versions in layouts.items():
        cells = ", ".join(f"`{n}` string" for n in (*names, "version", *PARTITIONS))
        reader = spark.read.schema(cells).option("header", True).option("sep", SINKS[sink])
        folders = [f"{sinks.path(sink)}/version={v}" for v in sorted(versions)]
        parts.append(reader.option("basePath", sinks.path(sink)).csv(folders))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in PARTITIONS))
    return append(*parts).join(F.broadcast(live), ["version", *PARTITIONS], "left_semi").drop("version")


def vacuum(spark: SparkSession, sinks: Sinks) -> list[str]:
    """Remove versions that no group is read from, and those never committed. Run it when no one publishes or reads."""
    live = {r["version"] for r in live_groups(spark, sinks).select("version").distinct().collect()}
    gone = set()
    for sink in SINKS:
        for name in log.names_in(spark, sinks.path(sink)):
            if name.startswith("version=") and name.removeprefix("version=") not in live:
                log.remove(spark, f"{sinks.path(sink)}/{name}")
                gone.add(name.removeprefix("version="))
    return sorted(gone)


def read_ledger(spark: SparkSession, commits: str) -> DataFrame:
    """Files already published, by path and token; none if nothing ever was."""
    found = log.read_commits(spark, commits, RECORD).select(F.explode("done").alias("d"))
    return found.select(F.col("d")[0].alias("path"), F.col("d")[1].alias("account")).distinct()


def processed(files: DataFrame, staged: DataFrame) -> DataFrame:
    """Path and token of the files without exceptions.

    They come from the file list, so a file whose rows were all filtered out is
    done as well.
    """
    failed = staged.filter(F.col("outcome") == EXCEPTION).select(
        F.col("src_file").alias("path"), F.col("AccountMajor").alias("major")
    ).distinct()
    return files.join(failed, ["path", "major"], "left_anti").select("path", "account")
