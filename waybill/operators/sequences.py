"""Ordered tracks: entry and exit events, visits, dwell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.temporal import seconds


def fence_events(track: DataFrame, by: list[str], order: list[str], fence: str, entry: str = "entry", exit: str = "exit") -> DataFrame:
    """Entry and exit flags of each row against the row before it; a move between two fences raises both."""
    window = W.partitionBy(*by).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    now = F.col(fence)
    was = F.col("__before")
    moved = ~now.eqNullSafe(was)
    return track.withColumn("__before", F.lag(fence).over(window)).withColumns({entry: now.isNotNull() & moved, exit: was.isNotNull() & moved}).drop("__before")


def visits(track: DataFrame, by: list[str], order: list[str], inside, entry: str, kind: str, time: str) -> DataFrame:
    """One row per visit with its fence kind and minutes; entries number the visits of a track's in-fence rows."""
    window = W.partitionBy(*by).orderBy(*(F.col(c).asc_nulls_last() for c in order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = track.where(inside).withColumn("visit_id", F.sum(F.col(entry).cast("int")).over(window))
    minutes = (F.max(seconds(F.col(time))) - F.min(seconds(F.col(time)))) / 60
    return numbered.groupBy(*by, "visit_id").agg(F.max(kind).alias(kind), minutes.alias("minutes"))


def dwell(visited: DataFrame, kind: str, total: str, average: str, decimals: int = 2) -> DataFrame:
    return visited.groupBy(kind).agg(F.count("*").alias(total), F.round(F.avg("minutes"), decimals).alias(average))


def dwell_of_all_kinds(track: DataFrame, by: list[str], fence: str, kind: str, time: str, average: str, decimals: int = 2) -> DataFrame:
    """Mean minutes per kind where a visit is all of a track's time in one fence; kinds without visits get 0."""
    minutes = (F.max(seconds(F.col(time))) - F.min(seconds(F.col(time)))) / 60
    per = track.where(F.col(fence).isNotNull()).groupBy(*by, fence).agg(F.max(kind).alias(kind), minutes.alias("minutes"))
    mean = per.groupBy(kind).agg(F.round(F.avg("minutes"), decimals).alias(average))
    kinds = track.where(F.col(kind).isNotNull()).select(kind).distinct()
    return kinds.join(mean, kind, "left").withColumn(average, F.coalesce(average, F.lit(0.0)))
