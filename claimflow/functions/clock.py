"""Times are parameters: no operator reads the clock itself."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Sao_Paulo"


def stamp(now: datetime | str | Column) -> Column:
    """A zone-free timestamp column, independent of the session zone."""
    if isinstance(now, Column):
        return now
    text = now if isinstance(now, str) else now.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def local_now(df: DataFrame, name: str = "now") -> DataFrame:
    """Add the local wall-clock time of the run."""
    return df.withColumn(name, F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), F.to_utc_timestamp(
        F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")))
