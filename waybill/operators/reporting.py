"""Serving and profiling queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K


def value_counts(df: DataFrame, column: str, total: str = "total") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(total))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``bin, low, total`` over equal bins between the extremes, nulls left out; empty bins are left out too."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0.0).alias("low"), F.lit(0).cast("long").alias("total")).limit(0)
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count("*").alias("total")).withColumn("low", F.lit(low) + F.col("bin") * F.lit(width))


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with nulls, distinct values and rows, all from one pass."""
    columns = columns or df.columns
    stats = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_distinct(c).alias("distinct_values"), F.count("*").alias("total")) for c in columns]
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per numeric column: known values, mean, standard deviation, extremes and quartiles, all from one pass.

    Quartiles lie between the two values around them; a column without values has nulls, one value no deviation.
    """
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        quartiles = {f"p{q}": F.percentile(v, F.lit(q / 100)) for q in (25, 50, 75)}
        all_of = {"total": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "low": F.min(v), **quartiles, "high": F.max(v)}
        stats.append(F.struct(F.lit(c).alias("column"), *(x.alias(n) for n, x in all_of.items())))
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in the order of a report: by each column in turn, falling where its name has a leading minus, nulls last."""
    return df.orderBy(*(F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns))


def fence_label(kind: Column) -> Column:
    """What reports call a kind of fence; unknown kinds keep their names."""
    label = kind
    for value, said in K.GEOFENCE_LABELS.items():
        label = F.when(kind == value, said).otherwise(label)
    return label


def trip_kpis(trips: DataFrame, valid: Column) -> DataFrame:
    """One row: valid and other trips, and of the valid ones distinct drivers, share of late ones, mean hours and speed."""
    ok = F.coalesce(valid, F.lit(False))
    of = lambda c: F.when(ok, c)
    return trips.agg(
        F.count_if(ok).alias("validas"), F.count_if(~ok).alias("invalidas"), F.count_distinct(of(F.col("motorista_id"))).alias("motoristas"),
        F.round(F.avg(of(F.col("atrasada_flag").cast("int"))), 6).alias("taxa_atraso"),
        F.round(F.avg(of(F.col("duracao_horas"))), 1).alias("duracao_media"), F.round(F.avg(of(F.col("velocidade_media_kmh"))), 1).alias("velocidade_media"),
    )


def position_kpis(positions: DataFrame, inside: Column, entry: str, exit: str, speed: str) -> DataFrame:
    """One row: positions, share of them inside a fence, mean speed, entries and exits together."""
    return positions.agg(
        F.count("*").alias("posicoes"), F.round(F.avg(inside.cast("int")), 6).alias("em_geocerca"),
        F.round(F.avg(speed), 1).alias("velocidade_media"), (F.count_if(entry) + F.count_if(exit)).alias("eventos"),
    )


def partitions(tables: list[DataFrame], column: str = "ingest_date") -> DataFrame:
    """Sorted distinct partition values of several tables."""
    each = [t.select(F.col(column).cast("string").alias(column)).distinct() for t in tables]
    return reduce(DataFrame.unionAll, each).distinct().orderBy(column)


def selected(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of the chosen values; choosing none means all."""
    return df.where(F.col(column).isin(values)) if values else df


def split_valid(df: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """(rows with all of ``required``, the rest)."""
    ok = reduce(lambda a, c: a & F.col(c).isNotNull(), required, F.lit(True))
    return df.where(ok), df.where(~ok)


def route_label(origin: Column, destination: Column, origin_id: Column, destination_id: Column) -> Column:
    return F.concat_ws(" → ", F.coalesce(origin, origin_id), F.coalesce(destination, destination_id))


def difference(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows missing from the right and rows unexpected in it, as multisets."""
    return left.exceptAll(right), right.exceptAll(left)


def keyed_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with ``kind``: missing (left only), unexpected (right only) or changed (other cells differ)."""
    rest = [c for c in left.columns if c not in keys]
    pack = lambda df, name: df.select(*keys, F.struct(*rest).alias(name))
    both = pack(left, "l").alias("a").join(pack(right, "r").alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    kind = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "unexpected").when(~F.col("l").eqNullSafe(F.col("r")), "changed")
    return both.select(*(F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys), kind.alias("kind")).where("kind is not null")
