"""Star join: a fact with its dimensions, orphans flagged and kept.

Joins carry no hints: small dimensions are broadcast by their measured size, large ones are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(df: DataFrame, key: str, attributes: dict[str, str], as_key: str | None = None, marker: str | None = None) -> DataFrame:
    """Key, renamed attributes and a marker that is true on a match; one table may play several roles."""
    columns = [F.col(key).alias(as_key or key), *(F.col(a).alias(b) for a, b in attributes.items())]
    return df.select(*columns, *([F.lit(True).alias(marker)] if marker else []))


def star_join(fact: DataFrame, dimensions: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins of a fact with each (dimension, key); a null key matches nothing."""
    for table, key in dimensions:
        fact = fact.join(table, key, "left")
    return fact


def orphans(fact: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Facts whose key is null or unknown."""
    return fact.join(table.select(key), key, "left_anti")


def track_summary(positions: DataFrame, trip: str, time: str, speed: str, names: tuple[str, str, str, str], decimals: int = 2) -> DataFrame:
    """Per trip: rounded mean speed, positions, first and last time. Aggregated before the join it feeds."""
    average, total, first, last = names
    return positions.where(F.col(trip).isNotNull()).groupBy(trip).agg(
        F.round(F.avg(speed), decimals).alias(average), F.count("*").alias(total), F.min(time).alias(first), F.max(time).alias(last)
    )
