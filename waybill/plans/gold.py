"""Gold tables from staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import temporal
from ..operators import enrich, geofence, quality, sequences
from ..operators.metrics import EN_ROUTE, IN_FENCE

VEHICLE = {a: f"veiculo_{a}" for a in ("placa", "marca", "modelo", "tipo", "capacidade_kg", "status")}
DRIVER = {a: f"motorista_{a}" for a in ("nome", "categoria_cnh", "base_operacional", "status")}
MARKERS = {"__vehicle": "vehicle_not_found", "__driver": "driver_not_found", "__origem": "origin_geofence_not_found", "__destino": "destination_geofence_not_found"}
POSITION = ["posicao_id", "viagem_id", "veiculo_id", "timestamp", "latitude", "longitude", "velocidade_kmh", "source_file", "ingested_at", "dq_observations", "quality_ok"]


def positions_in_fences(positions: DataFrame, fences: DataFrame) -> DataFrame:
    """Every position with its best fence (smallest radius, then id), class and events. Boundary points are inside."""
    named = geofence.active_fences(fences).select("geocerca_id", F.col("nome").alias("geocerca_nome"), F.col("tipo").alias("geocerca_tipo"), "raio_km", "geometry")
    found = geofence.match_best(positions.select(*POSITION), named, "longitude", "latitude", ["geocerca_id", "geocerca_nome", "geocerca_tipo", "raio_km"], "raio_km", "geocerca_id").drop("raio_km")
    placed = found.withColumn("classificacao_localizacao", F.when(F.col("geocerca_id").isNotNull(), IN_FENCE).otherwise(EN_ROUTE))
    events = sequences.fence_events(placed, ["viagem_id", "veiculo_id"], ["timestamp", "posicao_id"], "geocerca_id", "evento_entrada_geocerca", "evento_saida_geocerca")
    return events.withColumn("processed_at", F.current_timestamp())


def enriched_trips(trips: DataFrame, vehicles: DataFrame, drivers: DataFrame, fences: DataFrame, positions: DataFrame) -> DataFrame:
    """Trips with dimensions, tracking summary, durations and delay; orphans are flagged, never dropped."""
    fact = trips.withColumnRenamed("dq_observations", "__flags").drop("quality_ok", "processed_at")
    role = lambda r: enrich.dimension(fences, "geocerca_id", {a: f"{r}_{a}" for a in ("nome", "tipo", "uf")}, f"geocerca_{r}_id", f"__{r}")
    joined = enrich.star_join(fact, [
        (enrich.dimension(vehicles, "veiculo_id", VEHICLE, marker="__vehicle"), "veiculo_id"),
        (enrich.dimension(drivers, "motorista_id", DRIVER, marker="__driver"), "motorista_id"),
        (role("origem"), "geocerca_origem_id"),
        (role("destino"), "geocerca_destino_id"),
        (enrich.track_summary(positions, "viagem_id", "timestamp", "velocidade_kmh", ("velocidade_media_kmh", "num_posicoes", "primeira_posicao_ts", "ultima_posicao_ts")), "viagem_id"),
    ])
    start, planned, actual = F.col("data_inicio"), F.col("data_fim_prevista"), F.col("data_fim_real")
    timed = joined.withColumns({
        "duracao_horas": temporal.hours_between(start, actual), "duracao_prevista_horas": temporal.hours_between(start, planned),
        "atraso_horas": temporal.hours_between(planned, actual), "atrasada_flag": temporal.is_late(planned, actual, F.col("status"), "ATRASADA"),
        "mes": temporal.month_of(start),
    })
    return quality.merge_orphans(timed, "__flags", MARKERS).drop("__flags").withColumn("processed_at", F.current_timestamp())
