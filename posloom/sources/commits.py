"""Commits of a table's versions: one small file each, in order, whole or not there.

Data is first written in full under a name nobody reads. A commit then names it:
its file is written beside and renamed to the next number, which is one step of
the file system. Who reads the commits sees a version entirely or not at all.
Writers are one at a time; a number that is taken stops the second one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, folder: str) -> list[str]:
    system, target = file_system(spark, folder)
    return [entry.getPath().getName() for entry in system.listStatus(target)] if system.exists(target) else []


def numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, folder) if n.endswith(".json") and n[0].isdigit())


def commit(spark: SparkSession, folder: str, record: dict, number: int | None = None) -> int:
    """Put ``record`` under the next number (or ``number``) and return it."""
    if number is None:
        number = max(numbers(spark, folder), default=0) + 1
    system, target = file_system(spark, f"{folder}/{number:010d}.json")
    if system.exists(target):
        raise FileExistsError(f"commit {number} is there already: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    waiting = path(f"{folder}/_{uuid.uuid4().hex}")
    out = system.create(waiting)
    out.write(bytearray(json.dumps({"number": number, **record}).encode()))
    out.close()
    if not system.rename(waiting, target):
        system.delete(waiting, False)
        raise FileExistsError(f"commit {number} is there already: {folder}")
    return number


def read_commits(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All records, a row each; none if nothing was ever committed."""
    schema = f"number bigint, {schema}"
    if not numbers(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "[0-9]*.json").json(folder)


def remove(spark: SparkSession, path: str) -> None:
    system, target = file_system(spark, path)
    system.delete(target, True)
