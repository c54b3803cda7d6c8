"""Points and fences: flattening GeoJSON features, matching by grid cells, the best fence of a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry

PROPERTIES = ["geocerca_id", "nome", "tipo", "uf", "raio_km", "ativo"]
#: A fence is in this many cells along a side, about, at most.
MAX_CELLS = 64


def explode_features(collection: DataFrame) -> DataFrame:
    """One row per feature of a GeoJSON feature collection."""
    return collection.select(F.explode("features").alias("f")).select("f.*")


def _fields(df: DataFrame, name: str) -> list[str]:
    kind = df.schema[name].dataType if name in df.columns else None
    return kind.fieldNames() if isinstance(kind, T.StructType) else []


def flatten_features(df: DataFrame, properties: list[str] | None = None) -> DataFrame:
    """Properties as columns and the geometry as GeoJSON text with numeric coordinates.

    Absent properties are null columns; a null geometry, or one without fields, is null text.
    """
    have, shape = _fields(df, "properties"), _fields(df, "geometry")
    lead = [F.col(f"properties.{p}").alias(p) if p in have else F.lit(None).cast("string").alias(p) for p in properties or PROPERTIES]
    parts = [F.col("geometry.type").cast("string").alias("type") if "type" in shape else F.lit(None).cast("string").alias("type")]
    if "coordinates" in shape:
        parts.append(F.col("geometry.coordinates").try_cast("array<array<array<double>>>").alias("coordinates"))
    text = F.when(F.col("geometry").isNotNull(), F.to_json(F.struct(*parts))) if shape else F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in ("type", "properties", "geometry")]
    return df.select(*lead, text.alias("geometry"), *rest)


def active_fences(fences: DataFrame) -> DataFrame:
    """Fences that passed their checks, are active and have a closed polygon."""
    keep = F.coalesce(F.col("quality_ok") & F.col("ativo"), F.lit(False)) & F.col("geometry").isNotNull()
    return fences.where(keep & geometry.closed(F.col("geometry")))


def _bounded(fences: DataFrame) -> DataFrame:
    """Fences with their edges and bounding box; ``geometry`` is replaced."""
    lines = fences.withColumn("lines", geometry.edges(F.col("geometry"))).drop("geometry").where(F.size("lines") > 0)
    ends = lambda kind, axis: F.greatest(F.array_max(F.col(f"lines.{axis}1")), F.array_max(F.col(f"lines.{axis}2"))) if kind else F.least(F.array_min(F.col(f"lines.{axis}1")), F.array_min(F.col(f"lines.{axis}2")))
    return lines.withColumns({"x_min": ends(0, "x"), "x_max": ends(1, "x"), "y_min": ends(0, "y"), "y_max": ends(1, "y")})


def cell_size(bounded: DataFrame) -> float:
    """Side of the grid's cells: the fences' mean extent, and no less than the largest one's share."""
    extent = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"))
    mean, most = bounded.agg(F.avg(extent), F.max(extent)).first()
    return max(mean or 0.0, (most or 0.0) / MAX_CELLS) or 1.0


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def candidate_cells(fences: DataFrame, payload: list[str]) -> tuple[DataFrame, float]:
    """(one row per grid cell with the array ``fences`` of those whose box touches it, cell size).

    A cell's fences hold only the edges that can be on a point of the cell or to its right at its height, so a fence of
    many edges is not copied into all its cells.
    """
    bounded = _bounded(fences)
    size = cell_size(bounded)
    span = lambda axis: F.explode(F.sequence(_cell(F.col(f"{axis}_min"), size), _cell(F.col(f"{axis}_max"), size)))
    cells = bounded.withColumn("cell_x", span("x")).withColumn("cell_y", span("y"))
    slack = F.lit(size * 1e-6)  # a point is in its cell up to rounding
    low, high, left = F.col("cell_y") * size - slack, (F.col("cell_y") + 1) * size + slack, F.col("cell_x") * size - slack

    def near(e: Column) -> Column:
        return (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["x1"], e["x2"]) >= left)

    one = F.struct(*payload, "x_min", "x_max", "y_min", "y_max", F.filter("lines", near).alias("lines"))
    return cells.groupBy("cell_x", "cell_y").agg(F.collect_list(one).alias("fences")), size


def _placed(points: DataFrame, fences: DataFrame, x: str, y: str, payload: list[str], how: str) -> DataFrame:
    """``points`` with the array ``fences`` of their cell's; a cell table that is small is broadcast by its measured size."""
    cells, size = candidate_cells(fences.select(*payload, "geometry"), payload)
    return points.withColumns({"cell_x": _cell(F.col(x), size), "cell_y": _cell(F.col(y), size)}).join(cells, ["cell_x", "cell_y"], how)


def _inside(f: Column, x: str, y: str) -> Column:
    """Whether the point is in a fence: its box first, which most candidates fail, then its edges."""
    px, py = F.col(x), F.col(y)
    return px.between(f["x_min"], f["x_max"]) & py.between(f["y_min"], f["y_max"]) & geometry.contains(px, py, f["lines"])


def match_all(points: DataFrame, fences: DataFrame, x: str, y: str, payload: list[str]) -> DataFrame:
    """One row per point and containing fence, boundary included.

    Every point is in one cell, so the join never multiplies rows; only the candidates of its cell are laid out.
    """
    candidates = _placed(points, fences, x, y, payload, "inner").withColumn("m", F.explode("fences"))
    return candidates.where(_inside(F.col("m"), x, y)).select(*points.columns, *(F.col(f"m.{p}").alias(p) for p in payload))


def match_best(points: DataFrame, fences: DataFrame, x: str, y: str, payload: list[str], rank: str, key: str) -> DataFrame:
    """Every point with the containing fence of smallest ``rank`` (null last), ties by ``key``; null where none.

    The best of a cell's candidates is an array minimum, so neither the join nor anything after it multiplies or gathers
    rows.
    """
    order = lambda f: F.struct(f[rank].isNull().alias("none"), f[rank].alias("rank"), f[key].alias("key"), f.alias("fence"))
    found = F.filter("fences", lambda f: _inside(f, x, y))
    best = F.array_min(F.transform(found, order))["fence"]
    joined = _placed(points, fences, x, y, payload, "left").withColumn("m", best)
    return joined.select(*points.columns, *(F.col(f"m.{p}").alias(p) for p in payload))
