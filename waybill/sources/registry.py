"""Sources by name, and how each format is scanned: values stay text until a contract types them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.geofence import explode_features
from . import lake

OPTIONS = {
    "csv": {"header": "true", "encoding": "UTF-8"},
    "json": {"multiLine": "true", "primitivesAsString": "true"},
    "geojson": {"multiLine": "true", "primitivesAsString": "true"},
    "parquet": {},
}


@dataclass(frozen=True)
class Source:
    name: str
    format: str
    path: str
    options: dict[str, str] = field(default_factory=dict)
    active: bool = True


SOURCES = {
    s.name: s
    for s in (
        Source("veiculos", "csv", "veiculos/veiculos.csv"),
        Source("motoristas", "json", "motoristas/motoristas.json"),
        Source("geocercas", "geojson", "geocercas/geocercas.geojson"),
        Source("viagens", "json", "viagens/viagens.json"),
        Source("posicoes", "parquet", "rastreamento/posicoes.parquet"),
    )
}


def source(name: str, root: str = "") -> Source:
    """A registered source, its path below ``root``."""
    if name not in SOURCES:
        raise ValueError(f"no source named {name}; there are {', '.join(sorted(SOURCES))}")
    found = SOURCES[name]
    return replace(found, path=f"{root.rstrip('/')}/{found.path}" if root else found.path, options=dict(found.options))


def active_sources() -> list[str]:
    return [s.name for s in SOURCES.values() if s.active]


def scan(spark: SparkSession, src: Source) -> DataFrame:
    if src.format not in OPTIONS:
        raise ValueError(f"{src.name}: no scan for format {src.format}")
    reader = spark.read.options(**(OPTIONS[src.format] | src.options))
    if src.format == "geojson":
        return explode_features(reader.json(src.path))
    return reader.format(src.format).load(src.path)


def ingest(spark: SparkSession, src: Source, path: str, date: str) -> dict:
    """Scan a source into its raw partition with lineage columns; rows are counted by the write itself."""
    seen = Observation(f"raw_{src.name}")
    df = scan(spark, src).withColumns({"source_file": F.lit(src.path), "ingested_at": F.current_timestamp()})
    lake.write_partition(df.observe(seen, F.count(F.lit(1)).alias("records")), path, date)
    lake.mark_processed(spark, path, date)
    return {"layer": "raw", "path": path, "ingest_date": date, "records": seen.get["records"]}
