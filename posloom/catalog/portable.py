"""Result types that read the same in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def portable(df: DataFrame) -> DataFrame:
    """Exact decimals leave as DOUBLE, dates as ISO text. Last step only."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("double" if f.dataType.typeName() == "decimal" else "string")
        for f in df.schema.fields
        if f.dataType.typeName() in ("decimal", "date")
    }
    return df.withColumns(casts) if casts else df
