"""Drop folder to grid table: each new workbook is decoded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from posloom.sources.workbook import decode

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def workbook_stream(
    spark: SparkSession, raw_dir: str, archive_dir: str | None = None, glob: str = "*.xlsx"
) -> DataFrame:
    """Grid rows of new workbooks; with ``archive_dir`` read files move there."""
    reader = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob)
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return decode(reader.load(raw_dir))


def ingest_available(grid: DataFrame, table_dir: str, checkpoint: str) -> StreamingQuery:
    """Append all files present now, then stop; a restart goes on where it was."""
    return (
        grid.writeStream.format("parquet")
        .option("path", table_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
