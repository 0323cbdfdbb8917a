"""Calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(col: str | Column) -> Column:
    """Timestamp; text that is no date becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp")


def extract_date_features(df: DataFrame, col: str = "date") -> DataFrame:
    """Parsed date, month and weekend flag, the last two as text for encoders.

    A row without a date has no month and is not a weekend.
    """
    d = parse_date(col)
    return df.withColumn(col, d).withColumns({
        "month": F.month(col).cast("string"),
        "is_weekend": F.when(F.weekday(col) >= 5, "True").otherwise("False"),
    })
