"""Delimited text: typed files, unreadable lines, plain lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posloom.functions.text import line_record

CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    bad_lines: str = "keep",
) -> DataFrame:
    """A headed text file; every column is text unless ``schema`` says otherwise.

    ``bad_lines`` is ``keep`` (unreadable lines in ``_corrupt_record``),
    ``drop`` or ``fail``. A line is judged by all its cells, also those that no
    one asks for.
    """
    mode = {"keep": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}[bad_lines]
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", mode)
    )
    if schema is not None:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        if bad_lines == "keep":
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    lines = reader.csv(path)
    if bad_lines == "keep" or not lines.columns:
        return lines
    # The parser reads the cells that a query uses; this uses all of them.
    return lines.filter(F.size(F.array(*[F.col(f"`{c}`").isNull() for c in lines.columns])) > 0)


def read_records(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """Each line of a headless file as one map of name to trimmed value."""
    lines = spark.read.text(path)
    return lines.select(line_record(F.col("value"), names, sep).alias("record"))


def delimited_grid(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Delimited exports as grid rows with stable row numbers, read in splits.

    A file is one sheet without a name, number 0; a row's number is its line's
    number, blank lines included, and a blank cell is NULL. A file of any size is
    read by many tasks: rows are numbered within each block of a file as they
    are read, and the rows of earlier blocks are added from one count per block.
    Cells may be quoted, with doubled quotes inside; a line end within quotes
    ends the row all the same.
    """
    lines = spark.read.option("encoding", encoding).text(path).select(
        _plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    blocks = lines.groupBy("path", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # a row per block
    starts = blocks.select("path", "_block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_base"))
    return lines.join(starts, ["path", "_block"]).select(
        "path",
        "file_mtime",
        F.lit(None).cast("string").alias("sheet_name"),
        F.lit(0).alias("sheet_idx"),
        (F.col("_base") + F.col("_id") - F.col("_first")).alias("row_idx"),
        line_cells(F.col("value"), sep).alias("cells"),
    )


def _plain_path(uri: Column) -> Column:
    """A file's address as the file listing writes it: spaces as such, one slash after ``file:``."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def line_cells(line: Column, sep: str = ",") -> Column:
    """Cells of a line; a separator inside quotes separates nothing."""
    bare = F.regexp_replace(line, "^\ufeff|\r$", "")
    mark = sep if sep == "\t" else f"\\Q{sep}\\E"
    plain = F.split(bare, mark, -1)
    quoted = F.split(bare, f'{mark}(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)

    def cell(c: Column) -> Column:
        inner = F.replace(F.regexp_replace(c, '^\\s*"|"\\s*$', ""), F.lit('""'), F.lit('"'))
        value = F.when(F.ltrim(c).startswith('"'), inner).otherwise(c)
        return F.when(F.trim(value) != "", value)

    return F.transform(F.when(F.contains(bare, F.lit('"')), quoted).otherwise(plain), cell)
