"""One query per operator over the driver's tables, each with its DuckDB twin.

Trips are orders (driver: customer, vehicle: supplier by customer number, start: order date, planned end 30 days on,
actual end: last shipping date, positions: lines); orphans come from dropping dimension rows of negative balance. Tracks
are events per user; lattice points are lines by quantity and discount.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, temporal, text
from ..operators import contracts, enrich, geofence, metrics, quality, reporting, sequences, treatments
from ..operators.contracts import Check, ColumnSpec, TableContract
from ..sources import lake, registry
from . import gold, pipeline, tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- trips: the star ------------------------------------------------------------------------------------------------


def _drivers(spark, d):
    return _t(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").cast("string").alias("motorista_id"), F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("categoria_cnh"), F.col("c_nationkey").cast("string").alias("base_operacional"), F.lit("ATIVO").alias("status"))


def _vehicles(spark, d):
    status = F.when(F.col("s_suppkey") % 3 == 0, "EM_MANUTENCAO").otherwise("ATIVO")
    return _t(spark, d, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").cast("string").alias("veiculo_id"), F.col("s_name").alias("placa"), F.lit("M").alias("marca"), F.lit("X").alias("modelo"), F.lit("VUC").alias("tipo"), F.lit(1000).alias("capacidade_kg"), status.alias("status"))


def _fences(spark, d):
    return _t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("geocerca_id"), F.col("n_name").alias("nome"), F.lit("CLIENTE").alias("tipo"), F.col("n_regionkey").cast("string").alias("uf"))


def _positions(spark, d):
    return _t(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("posicao_id"), F.col("l_orderkey").cast("string").alias("viagem_id"), F.col("l_quantity").cast("int").alias("velocidade_kmh"), F.col("l_shipdate").cast("timestamp").alias("timestamp"))


def _trips(spark, d):
    orders, customers = _t(spark, d, "orders"), _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    ends = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ended"))
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left").join(ends, orders["o_orderkey"] == ends["l_orderkey"], "left")
    start = F.col("o_orderdate").cast("timestamp")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("viagem_id"), (F.col("o_custkey") % 100).cast("string").alias("veiculo_id"), F.col("o_custkey").cast("string").alias("motorista_id"),
        F.col("c_nationkey").cast("string").alias("geocerca_origem_id"), ((F.col("c_nationkey") * 7 + 3) % 25).cast("string").alias("geocerca_destino_id"),
        start.alias("data_inicio"), (start + F.expr("interval 30 days")).alias("data_fim_prevista"), F.col("ended").cast("timestamp").alias("data_fim_real"),
        F.element_at(F.create_map(F.lit("F"), F.lit("CONCLUIDA"), F.lit("O"), F.lit("EM_TRANSITO"), F.lit("P"), F.lit("ATRASADA")), F.col("o_orderstatus")).alias("status"), F.lit("").alias("dq_observations"),
    )


def _enriched(spark, d):
    return gold.enriched_trips(_trips(spark, d), _vehicles(spark, d), _drivers(spark, d), _fences(spark, d), _positions(spark, d))


TRIPS = """
WITH drivers AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0),
vehicles AS (SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN 'EM_MANUTENCAO' ELSE 'ATIVO' END AS status FROM supplier WHERE s_acctbal >= 0),
ends AS (SELECT l_orderkey, max(l_shipdate) AS ended, count(*) AS n, sum(CAST(CAST(l_quantity AS INT) AS DECIMAL(18,4))) AS speeds, min(l_shipdate) AS first FROM lineitem GROUP BY l_orderkey),
e AS (
  SELECT o.o_orderkey::VARCHAR AS viagem_id, (o.o_custkey % 100)::VARCHAR AS veiculo_id, o.o_custkey::VARCHAR AS motorista_id, c.c_nationkey::VARCHAR AS geocerca_origem_id,
    ((c.c_nationkey * 7 + 3) % 25)::VARCHAR AS geocerca_destino_id, CASE o_orderstatus WHEN 'F' THEN 'CONCLUIDA' WHEN 'O' THEN 'EM_TRANSITO' WHEN 'P' THEN 'ATRASADA' END AS status,
    strftime(o_orderdate, '%Y-%m') AS mes, a.n_name AS origem_nome, b.n_name AS destino_nome, d.c_name AS motorista_nome, v.s_name AS veiculo_placa,
    round((epoch(ended) - epoch(o_orderdate)) / 3600, 2) AS duracao_horas, round((epoch(ended) - epoch(o_orderdate) - 30 * 86400) / 3600, 2) AS atraso_horas,
    coalesce(o_orderstatus = 'P', false) OR coalesce(ended > o_orderdate + INTERVAL 30 DAY, false) AS atrasada_flag, ends.n AS num_posicoes, round(CAST(speeds / n AS DOUBLE), 2) AS velocidade_media_kmh,
    concat_ws(';', CASE WHEN v.s_suppkey IS NULL THEN 'vehicle_not_found' END, CASE WHEN d.c_custkey IS NULL THEN 'driver_not_found' END,
      CASE WHEN a.n_nationkey IS NULL THEN 'origin_geofence_not_found' END, CASE WHEN b.n_nationkey IS NULL THEN 'destination_geofence_not_found' END) AS dq_observations
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN ends ON o.o_orderkey = ends.l_orderkey LEFT JOIN drivers d ON o.o_custkey = d.c_custkey
    LEFT JOIN vehicles v ON o.o_custkey % 100 = v.s_suppkey LEFT JOIN nation a ON c.c_nationkey = a.n_nationkey LEFT JOIN nation b ON (c.c_nationkey * 7 + 3) % 25 = b.n_nationkey
), valid AS (SELECT * FROM e WHERE NOT contains(dq_observations, 'vehicle_not_found') AND NOT contains(dq_observations, 'driver_not_found'))
"""


def _metric(name):
    return lambda spark, d: metrics.build_metric(name, {"trips": _enriched(spark, d), "vehicles": _vehicles(spark, d)}).drop("processed_at")


@query(TRIPS + "SELECT mes, status, count(*) AS total_viagens FROM valid WHERE mes IS NOT NULL GROUP BY ALL")
def trips_by_month_status(spark, d):
    return _metric("viagens_por_mes_status")(spark, d)


@query(TRIPS + "SELECT geocerca_origem_id, geocerca_destino_id, max(origem_nome) AS origem_nome, max(destino_nome) AS destino_nome, round(avg(duracao_horas), 2) AS tempo_medio_horas, count(*) AS total_viagens FROM valid WHERE geocerca_origem_id IS NOT NULL AND geocerca_destino_id IS NOT NULL GROUP BY 1, 2")
def route_duration(spark, d):
    return _metric("tempo_medio_por_rota")(spark, d)


@query(TRIPS + "SELECT geocerca_origem_id, geocerca_destino_id, origem_nome, destino_nome, round(avg(duracao_horas), 2) AS tempo_medio_horas, count(*) AS total_viagens FROM e WHERE duracao_horas IS NOT NULL GROUP BY 1, 2, 3, 4")
def route_duration_variant(spark, d):
    return metrics.routes_with_duration(_enriched(spark, d))


@query(TRIPS + "SELECT mes, count(*) FILTER (atrasada_flag) AS viagens_atrasadas, count(*) AS viagens_total, round(count(*) FILTER (atrasada_flag)::DECIMAL(20,8) / count(*), 4)::DOUBLE AS taxa_atraso FROM valid GROUP BY mes")
def monthly_delay_rate(spark, d):
    return _metric("taxa_atraso_mensal")(spark, d)


@query(TRIPS + ", c AS (SELECT motorista_id, max(motorista_nome) AS motorista_nome, count(*) AS viagens_concluidas FROM valid WHERE status = 'CONCLUIDA' GROUP BY 1) SELECT row_number() OVER (ORDER BY viagens_concluidas DESC, motorista_id)::INT AS posicao_rank, * FROM c ORDER BY 1 LIMIT 10")
def top_drivers(spark, d):
    return _metric("top_motoristas")(spark, d)


@query(TRIPS + """, active AS (SELECT s_suppkey::VARCHAR AS id FROM vehicles WHERE status = 'ATIVO'), used AS (SELECT mes, count(DISTINCT veiculo_id) AS n FROM valid WHERE veiculo_id IN (SELECT id FROM active) GROUP BY mes)
SELECT m.mes, coalesce(n, 0) AS veiculos_com_viagem, (SELECT count(*) FROM active) AS veiculos_ativos_total, round(coalesce(n, 0)::DECIMAL(20,8) / (SELECT count(*) FROM active), 4)::DOUBLE AS taxa_utilizacao FROM (SELECT DISTINCT mes FROM valid) m LEFT JOIN used USING (mes)""")
def fleet_utilization(spark, d):
    return _metric("utilizacao_frota_mensal")(spark, d)


@query(TRIPS + "SELECT viagem_id, veiculo_placa, motorista_nome, origem_nome, destino_nome, duracao_horas, atraso_horas, atrasada_flag, mes, num_posicoes, velocidade_media_kmh, dq_observations, dq_observations = '' AS quality_ok FROM e")
def trip_enriched(spark, d):
    return _enriched(spark, d).select("viagem_id", "veiculo_placa", "motorista_nome", "origem_nome", "destino_nome", "duracao_horas", "atraso_horas", "atrasada_flag", "mes", "num_posicoes", "velocidade_media_kmh", "dq_observations", "quality_ok")


@query(TRIPS + "SELECT dq_observations, count(*) AS total FROM e GROUP BY 1")
def orphan_flags(spark, d):
    return reporting.value_counts(_enriched(spark, d), "dq_observations")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)")
def orphan_list(spark, d):
    known = _t(spark, d, "customer").where("c_acctbal >= 0").withColumnRenamed("c_custkey", "o_custkey")
    return enrich.orphans(_t(spark, d, "orders"), known, "o_custkey").select("o_orderkey")


@query("SELECT l_orderkey, round(CAST(avg(l_quantity) AS DOUBLE), 2) AS average, count(*) AS total, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY 1")
def track_summary(spark, d):
    return enrich.track_summary(_t(spark, d, "lineitem"), "l_orderkey", "l_shipdate", "l_quantity", ("average", "total", "first", "last"))


def _tracked(spark, d):
    """Trips of which every fifth has no positions."""
    return _enriched(spark, d).withColumn("distancia_km", F.lit(7)).withColumn("velocidade_media_kmh", F.when(F.col("viagem_id").cast("long") % 5 != 0, F.col("velocidade_media_kmh")))


TRACKED = TRIPS + ", s AS (SELECT *, CASE WHEN viagem_id::BIGINT % 5 <> 0 THEN velocidade_media_kmh END AS v FROM e) "


@query(TRACKED + "SELECT round(avg(v), 2) AS media_frota_kmh, min(v) AS min_kmh, max(v) AS max_kmh, count(v) AS com_telemetria, count(*) FILTER (v IS NULL) AS sem_telemetria FROM s")
def speed_summary(spark, d):
    return metrics.fleet_speed(_tracked(spark, d))


@query(TRACKED + "SELECT viagem_id, origem_nome, destino_nome, 7 AS distancia_km, num_posicoes, v AS velocidade_media_kmh FROM s WHERE v IS NOT NULL")
def speed_per_trip(spark, d):
    return metrics.speed_per_trip(_tracked(spark, d))


@query(TRIPS + """, active AS (SELECT s_suppkey::VARCHAR AS id FROM vehicles WHERE status = 'ATIVO')
SELECT mes, count(DISTINCT veiculo_id) AS veiculos_com_viagem, (SELECT count(*) FROM active) AS veiculos_ativos_total, round(count(DISTINCT veiculo_id)::DECIMAL(20,8) / (SELECT count(*) FROM active), 4)::DOUBLE AS taxa_utilizacao FROM e WHERE mes IS NOT NULL AND veiculo_id IN (SELECT id FROM active) GROUP BY mes""")
def utilization_variant(spark, d):
    return metrics.utilization_of_active_months(_enriched(spark, d), _vehicles(spark, d))


@query(TRIPS + """SELECT count(*) FILTER (ok) AS validas, count(*) FILTER (NOT ok) AS invalidas, count(DISTINCT motorista_id) FILTER (ok) AS motoristas, round(avg(atrasada_flag::INT) FILTER (ok), 6) AS taxa_atraso,
  round(avg(duracao_horas) FILTER (ok), 1) AS duracao_media, round(avg(velocidade_media_kmh) FILTER (ok), 1) AS velocidade_media FROM (SELECT *, dq_observations = '' AS ok FROM e)""")
def trip_kpis(spark, d):
    return reporting.trip_kpis(_enriched(spark, d), F.col("quality_ok"))


@query(TRIPS + ", c AS (SELECT mes, status, count(*) AS total_viagens FROM valid WHERE mes IS NOT NULL GROUP BY ALL) SELECT row_number() OVER (ORDER BY mes, total_viagens DESC, status)::INT AS place, * FROM c")
def presentation_order(spark, d):
    """Months upwards, the most frequent status of each first; the places of a report's few rows are counted on one task."""
    rows = reporting.ordered(_metric("viagens_por_mes_status")(spark, d), "mes", "-total_viagens", "status").collect()
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "place int, mes string, status string, total_viagens long")


# --- quality --------------------------------------------------------------------------------------------------------

PART = TableContract("part", (
    ColumnSpec("p_partkey", "bigint", True),
    ColumnSpec("p_size", "int", validations=(Check("positive", "bad_size"), Check("speed_within_limit", "big_size"))),
    ColumnSpec("p_retailprice", "double", validations=(Check("non_negative", "bad_price"), Check("required", "no_price"))),
    ColumnSpec("p_brand", "string", False, ("normalize",), (Check("plate_is_valid", "bad_plate"),)),
    ColumnSpec("p_name", "string", False, ("trim",), (Check("required", "no_name"),)),
))


def _part(spark, d):
    """Parts with every eleventh size null and every seventh negated."""
    size = F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).when(F.col("p_partkey") % 7 == 0, -F.col("p_size")).otherwise(F.col("p_size") * 4)
    return _t(spark, d, "part").withColumn("p_size", size).withColumn("p_brand", F.when(F.col("p_partkey") % 2 == 0, F.lit(" abc1d23 ")).otherwise(F.col("p_brand")))


def _judged(spark, d):
    return quality.validate(treatments.apply_treatments(_part(spark, d), PART), PART)


PARTS = """
WITH p AS (SELECT p_partkey, p_name, p_retailprice, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN -p_size ELSE p_size * 4 END AS p_size,
  upper(trim(CASE WHEN p_partkey % 2 = 0 THEN ' abc1d23 ' ELSE p_brand END)) AS p_brand FROM part),
c AS (SELECT *, coalesce(p_size > 0, false) AS a, coalesce(p_size <= 150, false) AS b, coalesce(p_retailprice >= 0, false) AS c, p_retailprice IS NOT NULL AS n,
  coalesce(regexp_full_match(p_brand, '[A-Z]{3}[0-9][A-Z0-9][0-9]{2}'), false) AS f, coalesce(trim(p_name) <> '', false) AS g FROM p),
j AS (SELECT *, concat_ws(';', CASE WHEN NOT a THEN 'bad_size' END, CASE WHEN NOT b THEN 'big_size' END, CASE WHEN NOT c THEN 'bad_price' END, CASE WHEN NOT n THEN 'no_price' END, CASE WHEN NOT f THEN 'bad_plate' END, CASE WHEN NOT g THEN 'no_name' END) AS dq_observations FROM c)
"""


@query(PARTS + "SELECT p_partkey, dq_observations, dq_observations = '' AS quality_ok FROM j")
def dq_flags(spark, d):
    return _judged(spark, d).select("p_partkey", "dq_observations", "quality_ok")


@query(PARTS + "SELECT p_partkey, CASE WHEN a AND b THEN p_size END AS p_size, CASE WHEN f THEN p_brand END AS p_brand FROM j")
def dq_nulling(spark, d):
    return _judged(spark, d).select("p_partkey", "p_size", "p_brand")


@query(PARTS + "SELECT dq_observations = '' AS approved, count(*) AS total FROM j GROUP BY 1")
def dq_split(spark, d):
    good, bad = quality.split_by_quality(_judged(spark, d))
    return good.select(F.lit(True).alias("approved")).unionAll(bad.select(F.lit(False).alias("approved"))).groupBy("approved").agg(F.count("*").alias("total"))


@query(PARTS + "SELECT reason, count(*) AS total FROM (SELECT unnest(string_split(dq_observations, ';')) AS reason FROM j) WHERE reason <> '' GROUP BY 1")
def rejection_histogram(spark, d):
    return quality.rejection_histogram(quality.split_by_quality(_judged(spark, d))[1])


CASCADE = TableContract("cascade", (
    ColumnSpec("id", "bigint", True),
    ColumnSpec("latitude", "double", validations=(Check("non_zero", "zeroed_latitude"), Check("coordinates_in_brazil", "outside", ("latitude", "longitude")))),
    ColumnSpec("longitude", "double", validations=(Check("non_zero", "zeroed_longitude"), Check("coordinates_in_brazil", "outside", ("latitude", "longitude")))),
))


@query("""
WITH p AS (SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value % 40 - 35 END AS lat, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value % 50 - 80 END AS lon FROM events),
c AS (SELECT *, coalesce((lat BETWEEN -33.75 AND 5.27 AND lon BETWEEN -73.99 AND -34.79) OR (lat = 0 AND lon = 0), false) AS box FROM p),
n AS (SELECT *, CASE WHEN lat <> 0 AND box THEN lat END AS l2 FROM c)
SELECT id, l2 AS latitude, CASE WHEN lon <> 0 AND coalesce((l2 BETWEEN -33.75 AND 5.27 AND lon BETWEEN -73.99 AND -34.79) OR (l2 = 0 AND lon = 0), false) THEN lon END AS longitude,
  concat_ws(';', CASE WHEN lat = 0 THEN 'zeroed_latitude' END, CASE WHEN NOT box THEN 'outside' END, CASE WHEN lon = 0 THEN 'zeroed_longitude' END) AS dq_observations FROM n""")
def dq_cascade(spark, d):
    rows = _t(spark, d, "events").select(
        F.col("event_id").alias("id"), F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("value") % 40 - 35).alias("latitude"),
        F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value") % 50 - 80).alias("longitude"),
    )
    return quality.validate(rows, CASCADE).drop("quality_ok")


@query("""SELECT count(*) AS total, count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) AS known, count(*) FILTER (regexp_full_match(c_name, 'Customer#[0-9]+')) AS named, count(*) FILTER (c_mktsegment IN ('C','D','E')) AS classes,
  count(*) FILTER (regexp_full_match(lpad(c_custkey::VARCHAR, 11, '0'), '[0-9]{11}')) AS licenses FROM customer""")
def dq_enum_regex(spark, d):
    seg = F.col("c_mktsegment")
    return _t(spark, d, "customer").agg(
        F.count("*").alias("total"), F.count_if(seg.isin("BUILDING", "MACHINERY")).alias("known"), F.count_if(F.col("c_name").rlike("^Customer#[0-9]+$")).alias("named"),
        F.count_if(text.license_class_ok(seg)).alias("classes"), F.count_if(text.license_ok(F.lpad(F.col("c_custkey").cast("string"), 11, "0"))).alias("licenses"),
    )


DOMAINS = {"driver_status_is_valid": "DRIVER_STATUS", "vehicle_status_is_valid": "VEHICLE_STATUS", "vehicle_type_is_valid": "VEHICLE_TYPES", "geofence_type_is_valid": "GEOFENCE_TYPES", "trip_status_is_valid": "TRIP_STATUS", "cnh_category_is_valid": "LICENSE_CLASSES"}
SAMPLES = ["ATIVO", "FERIAS", "EM_MANUTENCAO", "Bitrem", "BITREM", "CLIENTE", "PEDAGIO", "ATRASADA", "CONCLUIDA", "C", "X", "VUC"]


@query(
    "WITH v AS (SELECT n_nationkey AS k, (ARRAY[" + ",".join(f"'{s}'" for s in SAMPLES) + "])[(n_nationkey % 12 + 1)::INT] AS v FROM nation) SELECT k, v IN ('ATIVO','FERIAS','AFASTADO','DESLIGADO') AS driver_status_is_valid, v IN ('ATIVO','EM_MANUTENCAO','INATIVO') AS vehicle_status_is_valid, v IN ('VUC','Caminhão Toco','Caminhão Truck','Carreta Simples','Carreta LS','Bitrem') AS vehicle_type_is_valid, v IN ('CENTRO_DISTRIBUICAO','PEDAGIO','POSTO_COMBUSTIVEL','CLIENTE') AS geofence_type_is_valid, v IN ('EM_TRANSITO','CONCLUIDA','CANCELADA','ATRASADA') AS trip_status_is_valid, v IN ('C','D','E') AS cnh_category_is_valid FROM v"
)
def domain_checks(spark, d):
    value = F.get(F.array(*(F.lit(s) for s in SAMPLES)), F.col("n_nationkey") % 12)
    return _t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), *(quality.CHECKS[c](value).alias(c) for c in DOMAINS))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n = 1 AS first FROM r""")
def dq_unique(spark, d):
    lines = _t(spark, d, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    return quality.mark_first(lines, key, key, "first").select(*key, "l_partkey", "l_suppkey", "first")


RAW_VEHICLES = """
WITH w AS (SELECT p_partkey AS k, p_size, p_retailprice, p_type FROM part),
t AS (SELECT CASE WHEN k % 13 <> 0 THEN 'V' || (k % 400) END AS id, CASE WHEN k % 2 = 0 THEN 'ABC1D23' ELSE 'XX' || k END AS placa, upper(trim(p_type)) AS marca,
  CASE WHEN k % 5 <> 0 THEN p_size END AS ano, CASE WHEN k % 3 = 0 THEN 'Bitrem' ELSE 'bitrem' END AS tipo, CASE WHEN k % 4 = 0 THEN -p_size ELSE p_size END AS km,
  CASE WHEN k % 6 = 0 THEN 'ATIVO' WHEN k % 6 = 1 THEN 'PARADO' ELSE 'INATIVO' END AS status, CASE WHEN k % 7 <> 0 THEN DATE '2024-03-15' END AS revisao FROM w),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY placa, marca, ano NULLS LAST, tipo, km, status, revisao NULLS LAST) AS turn FROM t WHERE id IS NOT NULL),
c AS (SELECT *, regexp_full_match(placa, '[A-Z]{3}[0-9][A-Z0-9][0-9]{2}') AS a, tipo = 'Bitrem' AS b, km >= 0 AS m, status IN ('ATIVO', 'INATIVO') AS s, revisao IS NOT NULL AS r, turn = 1 AS u FROM n),
f AS (SELECT *, concat_ws(';', CASE WHEN NOT a THEN 'invalid_plate' END, CASE WHEN NOT b THEN 'invalid_vehicle_type' END, CASE WHEN NOT m THEN 'negative_mileage' END,
  CASE WHEN NOT s THEN 'invalid_status' END, CASE WHEN NOT r THEN 'missing_revision_date' END, CASE WHEN NOT u THEN 'duplicate_key' END) AS reasons FROM c)
"""


def _raw_vehicles(spark, d):
    """Parts as raw vehicles, all text: some without a key, many that share one."""
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    return _t(spark, d, "part").select(
        F.when(k % 13 == 0, F.lit("")).otherwise(F.concat(F.lit(" v"), (k % 400).cast("string"))).alias("veiculo_id"),
        F.when(k % 2 == 0, " abc1d23").otherwise(F.concat(F.lit("xx"), k.cast("string"))).alias("placa"), F.concat(F.lit(" "), "p_type").alias("marca"), F.lit("m").alias("modelo"),
        F.when(k % 5 == 0, "n/a").otherwise(size).alias("ano_fabricacao"), F.when(k % 3 == 0, " Bitrem ").otherwise("bitrem").alias("tipo"), F.lit("1").alias("capacidade_kg"), F.lit("2").alias("capacidade_paletes"),
        F.when(k % 4 == 0, F.concat(F.lit("-"), size)).otherwise(size).alias("km_atual"), F.when(k % 6 == 0, " ativo").when(k % 6 == 1, "parado").otherwise("INATIVO").alias("status"),
        F.when(k % 7 == 0, "2024-02-31").otherwise("2024-03-15").alias("data_ultima_revisao"), F.lit("f").alias("source_file"), F.lit(None).cast("timestamp").alias("ingested_at"),
    )


@query(RAW_VEHICLES + "SELECT CASE WHEN u THEN id END AS veiculo_id, CASE WHEN a THEN placa END AS placa, ano AS ano_fabricacao, CASE WHEN b THEN tipo END AS tipo, CASE WHEN m THEN km END AS km_atual, CASE WHEN s THEN status END AS status, revisao AS data_ultima_revisao, reasons AS dq_observations, reasons = '' AS quality_ok FROM f")
def clean_and_validate(spark, d):
    """A whole table contract over raw rows: treatments, casts, checks, uniqueness, cascade nulling, the closed schema."""
    contract = tables.STAGING["veiculos"]
    out = contracts.conform(pipeline.clean(_raw_vehicles(spark, d), contract), contract)
    return out.select("veiculo_id", "placa", "ano_fabricacao", "tipo", "km_atual", "status", "data_ultima_revisao", "dq_observations", "quality_ok")


@query(RAW_VEHICLES + """, x AS (SELECT unnest(string_split(reasons, ';')) AS reason FROM f WHERE reasons <> ''), sums AS (SELECT count(*) FILTER (reasons = '') AS approved, count(*) FILTER (reasons <> '') AS rejected FROM f)
SELECT approved, rejected, round(100.0 * rejected / (approved + rejected), 2)::DOUBLE AS rejected_pct, reason, total FROM sums, (SELECT reason, count(*) AS total FROM x GROUP BY 1)""")
def rejection_metrics(spark, d):
    """The numbers of a rejection report, and each reason with its rows."""
    found = quality.rejection_metrics(pipeline.clean(_raw_vehicles(spark, d), tables.STAGING["veiculos"]))
    rows = [(found["approved"], found["rejected"], found["rejected_pct"], reason, n) for reason, n in found["reasons"].items()]
    return spark.createDataFrame(rows, "approved long, rejected long, rejected_pct double, reason string, total long")


@query(PARTS + """, r AS (SELECT unnest(string_split(dq_observations, ';')) AS reason FROM j), per AS (SELECT reason, count(*) AS n FROM r WHERE reason <> '' GROUP BY 1),
whole AS (SELECT count(*) FILTER (dq_observations <> '') AS bad, count(*) AS total FROM j)
SELECT format('part: {} rows rejected ({:.2f}%): ', any_value(bad), any_value(round(100.0 * bad / total, 2))) || string_agg(format('{}: {} ({:.1f}%)', reason, n, 100.0 * n / bad), ', ' ORDER BY n DESC, reason) AS message FROM per, whole""")
def rejection_alert(spark, d):
    return spark.createDataFrame([(quality.rejection_message("part", quality.rejection_metrics(_judged(spark, d))),)], "message string")


OVERRIDE = TableContract("override", (
    ColumnSpec("id", "bigint", True),
    ColumnSpec("latitude", "double", validations=(Check("coordinates_in_brazil", "outside", ("latitude", "longitude"), ("longitude",)),)),
    ColumnSpec("longitude", "double", validations=(Check("unique", "seen", ("longitude", "latitude"), ("absent", "latitude")),)),
))


@query("""WITH p AS (SELECT event_id AS id, floor(value % 40) - 35 AS lat, floor(value % 50) - 80 AS lon FROM events),
c AS (SELECT *, coalesce((lat BETWEEN -33.75 AND 5.27 AND lon BETWEEN -73.99 AND -34.79) OR (lat = 0 AND lon = 0), false) AS box, row_number() OVER (PARTITION BY lon, lat ORDER BY id) = 1 AS first FROM p)
SELECT id, CASE WHEN first THEN lat END AS latitude, CASE WHEN box THEN lon END AS longitude, concat_ws(';', CASE WHEN NOT box THEN 'outside' END, CASE WHEN NOT first THEN 'seen' END) AS dq_observations FROM c""")
def check_resolution(spark, d):
    """Checks over several columns that null others than their own; what a contract cannot resolve is an error."""
    rows = _t(spark, d, "events").select(F.col("event_id").alias("id"), (F.floor(F.col("value") % 40) - 35).cast("double").alias("latitude"), (F.floor(F.col("value") % 50) - 80).cast("double").alias("longitude"))
    for check in (Check("no_such_check", "x"), Check("positive", "x", ("no_such_column",))):
        try:
            quality.validate(rows, TableContract("wrong", (ColumnSpec("id", "bigint", True, validations=(check,)),)))
        except contracts.ContractError:
            continue
        raise AssertionError(check)
    return quality.validate(rows, OVERRIDE).drop("quality_ok")


@query("SELECT p_partkey, trim(' ' || p_name || '  ') AS p_name, trim(' ' || p_brand) AS p_brand, ' ' || p_type AS p_type FROM part")
def trim_columns(spark, d):
    rows = _t(spark, d, "part").select("p_partkey", F.concat(F.lit(" "), "p_name", F.lit("  ")).alias("p_name"), F.concat(F.lit(" "), "p_brand").alias("p_brand"), F.concat(F.lit(" "), "p_type").alias("p_type"))
    return treatments.trim_columns(rows, ["p_name", "p_brand"])


# --- scalars --------------------------------------------------------------------------------------------------------

_W = lambda n: " + ".join(f"CAST(substr(x, {i + 1}, 1) AS INT) * {n + 1 - i}" for i in range(n))


@query(f"""WITH c AS (SELECT c_custkey, lpad((c_custkey * 7919)::VARCHAR, 9, '0') AS h FROM customer), f AS (SELECT c_custkey, h || CASE WHEN c_custkey % 2 = 0 THEN '00' ELSE '25' END AS x FROM c)
SELECT c_custkey, x <> repeat(substr(x, 1, 1), 11) AND ((({_W(9)}) * 10) % 11) % 10 = CAST(substr(x, 10, 1) AS INT) AND ((({_W(10)}) * 10) % 11) % 10 = CAST(substr(x, 11, 1) AS INT) AS ok FROM f""")
def check_digits(spark, d):
    head = F.lpad((F.col("c_custkey") * 7919).cast("string"), 9, "0")
    value = F.concat(head, F.when(F.col("c_custkey") % 2 == 0, "00").otherwise("25"))
    return _t(spark, d, "customer").select("c_custkey", text.tax_id_ok(value).alias("ok"))


PHONES = """WITH p AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN '+55 (0' || (c_custkey % 89 + 11) || ') 2' || lpad((c_custkey * 37 % 10000000)::VARCHAR, 7, '0') WHEN 1 THEN '(' || (c_custkey % 89 + 11) || ') 9' || lpad((c_custkey * 91 % 100000000)::VARCHAR, 8, '0')
  WHEN 2 THEN (c_custkey % 89 + 11) || ' 1' || lpad((c_custkey % 10000000)::VARCHAR, 7, '0') ELSE 'n/a' END AS raw FROM customer),
q AS (SELECT *, regexp_replace(raw, '[^0-9]', '', 'g') AS g FROM p), n AS (SELECT k, regexp_replace(CASE WHEN starts_with(g, '55') AND length(g) >= 12 THEN substr(g, 3) ELSE g END, '^0+', '') AS phone FROM q)
"""


def _phones(spark, d):
    k = F.col("c_custkey")
    code = (k % 89 + 11).cast("string")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    raw = F.when(k % 4 == 0, F.concat(F.lit("+55 (0"), code, F.lit(") 2"), pad(k * 37 % 10000000, 7))).when(k % 4 == 1, F.concat(F.lit("("), code, F.lit(") 9"), pad(k * 91 % 100000000, 8)))
    return _t(spark, d, "customer").select(k.alias("k"), raw.when(k % 4 == 2, F.concat(code, F.lit(" 1"), pad(k % 10000000, 7))).otherwise("n/a").alias("raw"))


@query(PHONES + "SELECT k, phone FROM n")
def phone_normalize(spark, d):
    return _phones(spark, d).select("k", text.national_phone(F.col("raw")).alias("phone"))


@query(PHONES + ", m(code, state) AS (VALUES " + ",".join(f"('{c}','{s}')" for c, s in text.STATE_OF_CODE.items()) + ") SELECT k, state, state IS NOT NULL AND ((length(phone) = 10 AND substr(phone, 3, 1) BETWEEN '2' AND '9') OR (length(phone) = 11 AND substr(phone, 3, 1) = '9')) AS ok FROM n LEFT JOIN m ON substr(phone, 1, 2) = code")
def area_code_state(spark, d):
    return _phones(spark, d).select("k", text.state_of(text.area_code(F.col("raw"))).alias("state"), text.phone_ok(F.col("raw")).alias("ok"))


MESSY = TableContract("messy", (
    ColumnSpec("id", "bigint", True), ColumnSpec("name", "string", False, ("normalize",)), ColumnSpec("size", "int"), ColumnSpec("flag", "boolean"),
    ColumnSpec("day", "timestamp", False, ("parse_date",)), ColumnSpec("name", "string", False, ("normalize_cpf",), (), "numbers"),
))


def _messy(spark, d):
    k = F.col("p_partkey")
    return _t(spark, d, "part").select(
        F.when(k % 10 != 0, k.cast("string")).alias("id"), F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("name"), F.when(k % 3 == 0, "n/a").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.when(k % 2 == 0, "true").otherwise("sim").alias("flag"), F.when(k % 4 == 0, " 2024-02-30 10:00:00").otherwise(" 2024-03-15 10:20:30 ").alias("day"),
    )


MESS = """WITH m AS (SELECT CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS id, upper(trim(p_name)) AS name, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS size, CASE WHEN p_partkey % 2 = 0 THEN true END AS flag,
  CASE WHEN p_partkey % 4 <> 0 THEN TIMESTAMP '2024-03-15 10:20:30' END AS day FROM part) """


@query(MESS + "SELECT id, name, size, flag, day FROM m WHERE id IS NOT NULL")
def treatments_cast(spark, d):
    return treatments.apply_treatments(_messy(spark, d), MESSY).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query(MESS + "SELECT id, regexp_replace(name, '[^0-9]', '', 'g') AS numbers FROM m WHERE id IS NOT NULL")
def derived_column(spark, d):
    return treatments.derive(treatments.apply_treatments(_messy(spark, d), MESSY), MESSY).select("id", "numbers")


@query("SELECT n_name, n_nationkey FROM nation")
def contract_projection(spark, d):
    return contracts.conform(_t(spark, d, "nation"), TableContract("nation", (ColumnSpec("n_name", "string"), ColumnSpec("n_nationkey", "int"))))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def month_key(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", temporal.month_of(F.col("o_orderdate")).alias("month"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS again FROM events")
def json_extract(spark, d):
    parsed = F.from_json("props", "k bigint")
    return _t(spark, d, "events").select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("again"))


@query("SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::INT AS positive, len(embedding)::INT AS n, embedding[1]::DOUBLE AS first, embedding[len(embedding)]::DOUBLE AS last FROM embeddings")
def array_hof(spark, d):
    e = F.col("embedding")
    return _t(spark, d, "embeddings").select("vec_id", F.size(F.filter(e, lambda x: x > 0)).alias("positive"), F.size(e).alias("n"), F.get(e, F.lit(0)).cast("double").alias("first"), F.try_element_at(e, F.lit(-1)).cast("double").alias("last"))


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'Distribution' WHEN n_regionkey = 1 THEN 'Toll' ELSE n_name END AS label, n_name || ' → ' || n_regionkey AS route FROM nation")
def label_case(spark, d):
    label = F.when(F.col("n_regionkey") == 0, "Distribution").when(F.col("n_regionkey") == 1, "Toll").otherwise(F.col("n_name"))
    route = reporting.route_label(F.col("n_name"), F.lit(None).cast("string"), F.lit("?"), F.col("n_regionkey").cast("string"))
    return _t(spark, d, "nation").select("n_nationkey", label.alias("label"), route.alias("route"))


# --- geometry -------------------------------------------------------------------------------------------------------


def _ring(*points) -> str:
    return "[" + ",".join(f"[{x},{y}]" for x, y in points) + "]"


def _polygon(*rings) -> str:
    return '{"type":"Polygon","coordinates":[' + ",".join(rings) + "]}"


def _box(x1, y1, x2, y2) -> str:
    return _ring((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))


BOXES = [("A", 5.0, _polygon(_box(5, 1, 15, 4))), ("B", 3.0, _polygon(_box(10, 2, 30, 8))), ("C", None, _polygon(_box(40, 0, 50, 10)))]
TRIANGLE = [("T", 1.0, _polygon(_ring((5, 0), (45, 0), (25, 10), (5, 0))))]
CONCAVE = [("L", 1.0, _polygon(_ring((5, 1), (40, 1), (40, 4), (20, 4), (20, 9), (5, 9), (5, 1))))]
HOLED = [("H", 1.0, _polygon(_box(5, 1, 45, 9), _box(15, 3, 30, 6)))]
BOX_SQL = "(CASE f WHEN 'A' THEN x BETWEEN 5 AND 15 AND y BETWEEN 1 AND 4 WHEN 'B' THEN x BETWEEN 10 AND 30 AND y BETWEEN 2 AND 8 ELSE x BETWEEN 40 AND 50 AND y BETWEEN 0 AND 10 END)"
LATTICE = "WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS x, round(l_discount * 100) AS y FROM lineitem) "


def _named(spark, rows):
    return spark.createDataFrame(rows, "fence string, radius double, geometry string")


def _lattice(spark, d):
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("x"), F.round(F.col("l_discount") * 100).alias("y"))


def _counted(spark, d, shapes):
    return geofence.match_all(_lattice(spark, d), _named(spark, shapes), "x", "y", ["fence"]).groupBy("fence", "x", "y").agg(F.count("*").alias("total"))


def _count_sql(name, where):
    return LATTICE + f"SELECT '{name}' AS fence, x, y, count(*) AS total FROM p WHERE {where} GROUP BY x, y"


@query(LATTICE + f"SELECT f AS fence, x, y, count(*) AS total FROM p, (VALUES ('A'), ('B'), ('C')) v(f) WHERE {BOX_SQL} GROUP BY ALL")
def pip_boxes(spark, d):
    return _counted(spark, d, BOXES)


@query(_count_sql("T", "y >= 0 AND 2 * y <= x - 5 AND 2 * y <= 45 - x"))
def pip_convex(spark, d):
    return _counted(spark, d, TRIANGLE)


@query(_count_sql("L", "(x BETWEEN 5 AND 40 AND y BETWEEN 1 AND 4) OR (x BETWEEN 5 AND 20 AND y BETWEEN 1 AND 9)"))
def pip_concave(spark, d):
    return _counted(spark, d, CONCAVE)


@query(_count_sql("H", "x BETWEEN 5 AND 45 AND y BETWEEN 1 AND 9 AND NOT (x > 15 AND x < 30 AND y > 3 AND y < 6)"))
def pip_holed(spark, d):
    return _counted(spark, d, HOLED)


@query(LATTICE + "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN x BETWEEN 10 AND 30 AND y BETWEEN 2 AND 8 THEN 'B' WHEN x BETWEEN 5 AND 15 AND y BETWEEN 1 AND 4 THEN 'A' WHEN x BETWEEN 40 AND 50 AND y BETWEEN 0 AND 10 THEN 'C' END AS fence FROM p")
def best_fence(spark, d):
    return geofence.match_best(_lattice(spark, d), _named(spark, BOXES), "x", "y", ["fence", "radius"], "radius", "fence").select("l_orderkey", "l_linenumber", "l_partkey", "fence")


SHAPES = [
    (1, _polygon(_box(-50, -20, -49, -19))), (2, '{"type":"Point","coordinates":[1,2]}'), (3, "not json"), (4, _polygon(_ring((-50, -20), (-49, -20), (-49, -19)))),
    (5, _polygon(_ring((-50, -20), (-49, -20), (-49, -19), (-50, -19)))), (6, _polygon(_ring((0, 0), (-49, -20), (-49, -19), (0, 0)))), (7, _polygon(_box(10, 10, 11, 11))), (8, None),
]


@query("SELECT * FROM (VALUES (1, true, true, true), (2, false, true, false), (3, false, true, false), (4, false, true, false), (5, true, true, false), (6, false, true, true), (7, true, false, true), (8, true, true, false)) v(id, ok, within, matchable)")
def polygon_validity(spark, d):
    g = F.col("geometry")
    return spark.createDataFrame(SHAPES, "id int, geometry string").select("id", geometry.polygon_ok(g).alias("ok"), geometry.polygon_in_bounds(g).alias("within"), geometry.closed(g).alias("matchable"))


@query("""SELECT 'G' || n_nationkey AS geocerca_id, n_name AS nome, NULL::VARCHAR AS uf, CASE WHEN n_nationkey % 5 <> 0 THEN '{"type":"Polygon","coordinates":[[[' || n_nationkey || '.5,1.0],[2.0,' || n_regionkey || '.0]]]}' END AS geometry FROM nation""")
def geojson_flatten(spark, d):
    k, r = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    rings = F.array(F.array(F.array(F.concat(k, F.lit(".5")), F.lit("1")), F.array(F.lit("2.0"), r)))
    shape = F.when(F.col("n_nationkey") % 5 != 0, F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")))
    features = _t(spark, d, "nation").select(F.lit("Feature").alias("type"), F.struct(F.concat(F.lit("G"), k).alias("geocerca_id"), F.col("n_name").alias("nome")).alias("properties"), shape.alias("geometry"))
    return geofence.flatten_features(features, ["geocerca_id", "nome", "uf"])


# --- tracks ---------------------------------------------------------------------------------------------------------

TRACK_FENCES = [("morning", 2.0, _polygon(_box(6, 0, 12, 60))), ("late", 1.0, _polygon(_box(11, 20, 22, 90)))]
TRACK = """WITH p AS (SELECT event_id, user_id, ts, CASE WHEN hour(ts) BETWEEN 11 AND 22 AND value BETWEEN 20 AND 90 THEN 'late' WHEN hour(ts) BETWEEN 6 AND 12 AND value BETWEEN 0 AND 60 THEN 'morning' END AS fence FROM events),
l AS (SELECT *, lag(fence) OVER w AS was FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id)),
t AS (SELECT event_id, user_id, ts, fence, fence IS NOT NULL AND fence IS DISTINCT FROM was AS entry, was IS NOT NULL AND fence IS DISTINCT FROM was AS exit FROM l),
v AS (SELECT *, sum(entry::INT) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id ROWS UNBOUNDED PRECEDING) AS visit_id FROM t WHERE fence IS NOT NULL),
visits AS (SELECT user_id, visit_id::BIGINT AS visit_id, max(fence) AS fence, (epoch(max(ts)) - epoch(min(ts))) / 60 AS minutes FROM v GROUP BY 1, 2)
"""


def _track(spark, d):
    points = _t(spark, d, "events").select("event_id", "user_id", "ts", F.hour("ts").cast("double").alias("x"), F.col("value").alias("y"))
    found = geofence.match_best(points, _named(spark, TRACK_FENCES), "x", "y", ["fence", "radius"], "radius", "fence")
    return sequences.fence_events(found, ["user_id"], ["ts", "event_id"], "fence").select("event_id", "user_id", "ts", "fence", "entry", "exit")


@query(TRACK + "SELECT * FROM t")
def fence_events(spark, d):
    return _track(spark, d)


def _visits(spark, d):
    return sequences.visits(_track(spark, d), ["user_id"], ["ts", "event_id"], F.col("fence").isNotNull(), "entry", "fence", "ts")


@query(TRACK + "SELECT user_id, visit_id, fence, round(minutes, 4) AS minutes FROM visits")
def fence_visits(spark, d):
    return _visits(spark, d).withColumn("minutes", F.round("minutes", 4))


@query(TRACK + "SELECT fence, count(*) AS visits, round(avg(minutes), 2) AS average FROM visits GROUP BY 1")
def fence_dwell(spark, d):
    return sequences.dwell(_visits(spark, d), "fence", "visits", "average")


@query("""WITH k AS (SELECT *, event_type = 'view' AS seen FROM events), m AS (SELECT user_id, max(event_type) AS event_type, (epoch(max(ts)) - epoch(min(ts))) / 60 AS minutes FROM k WHERE seen GROUP BY user_id)
SELECT t.event_type, coalesce(round(avg(minutes), 2), 0.0) AS average FROM (SELECT DISTINCT event_type FROM events) t LEFT JOIN m USING (event_type) GROUP BY 1""")
def dwell_all_types(spark, d):
    track = _t(spark, d, "events").withColumn("fence", F.when(F.col("event_type") == "view", "view"))
    return sequences.dwell_of_all_kinds(track, ["user_id"], "fence", "event_type", "ts", "average")


def _fence_rows(spark):
    """Fences of tracks as staged rows; one is switched off and one failed its checks, so neither counts."""
    everywhere = _polygon(_box(0, 0, 100, 100))
    rows = [(*f, True, True) for f in TRACK_FENCES] + [("off", 0.5, everywhere, False, True), ("bad", 0.1, everywhere, True, False), ("unknown", 0.2, everywhere, None, True)]
    return spark.createDataFrame(rows, "geocerca_id string, raio_km double, geometry string, ativo boolean, quality_ok boolean").withColumns({"nome": F.upper("geocerca_id"), "tipo": F.lit("CLIENTE")})


def _tracked_positions(spark, d):
    return _t(spark, d, "events").select(
        F.col("event_id").cast("string").alias("posicao_id"), F.col("user_id").cast("string").alias("viagem_id"), F.lit("v").alias("veiculo_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("latitude"), F.hour("ts").cast("double").alias("longitude"), (F.col("event_id") % 90).cast("int").alias("velocidade_kmh"), F.lit("f").alias("source_file"),
        F.lit(None).cast("timestamp").alias("ingested_at"), F.lit("").alias("dq_observations"), F.lit(True).alias("quality_ok"), F.lit("left out").alias("more"),
    )


POSITIONS = """WITH p AS (SELECT event_id::VARCHAR AS posicao_id, user_id, ts, (event_id % 90)::INT AS speed, CASE WHEN hour(ts) BETWEEN 11 AND 22 AND value BETWEEN 20 AND 90 THEN 'late' WHEN hour(ts) BETWEEN 6 AND 12 AND value BETWEEN 0 AND 60 THEN 'morning' END AS fence FROM events),
l AS (SELECT *, lag(fence) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, posicao_id) AS was FROM p),
t AS (SELECT *, fence IS NOT NULL AND fence IS DISTINCT FROM was AS entered, was IS NOT NULL AND fence IS DISTINCT FROM was AS left_ FROM l)
"""


@query(POSITIONS + "SELECT posicao_id, user_id::VARCHAR AS viagem_id, fence AS geocerca_id, upper(fence) AS geocerca_nome, CASE WHEN fence IS NULL THEN 'em_rota' ELSE 'em_geocerca' END AS classificacao_localizacao, entered AS evento_entrada_geocerca, left_ AS evento_saida_geocerca, 13 AS columns FROM t")
def positions_in_fences(spark, d):
    """The gold table of positions: projection, active fences, best match, class, events, closed schema."""
    placed = contracts.conform(gold.positions_in_fences(_tracked_positions(spark, d), _fence_rows(spark)), tables.GOLD["posicoes_geocercas"])
    assert "more" not in placed.columns
    kept = [c for c in placed.columns if c not in ("source_file", "ingested_at", "dq_observations", "quality_ok", "processed_at")]
    return placed.select("posicao_id", "viagem_id", "geocerca_id", "geocerca_nome", "classificacao_localizacao", "evento_entrada_geocerca", "evento_saida_geocerca", F.lit(len(kept)).alias("columns"))


@query("SELECT 'geocerca_id' AS name, 2 AS rows")
def active_fences(spark, d):
    kept = geofence.active_fences(_fence_rows(spark))
    return kept.agg(F.lit("geocerca_id").alias("name"), F.count("*").cast("int").alias("rows"))


@query(POSITIONS + "SELECT count(*) AS posicoes, round(avg((fence IS NOT NULL)::INT), 6) AS em_geocerca, round(avg(speed), 1) AS velocidade_media, count(*) FILTER (entered) + count(*) FILTER (left_) AS eventos FROM t")
def position_kpis(spark, d):
    placed = gold.positions_in_fences(_tracked_positions(spark, d), _fence_rows(spark))
    return reporting.position_kpis(placed, F.col("classificacao_localizacao") == metrics.IN_FENCE, "evento_entrada_geocerca", "evento_saida_geocerca", "velocidade_kmh")


@query(POSITIONS + """, v AS (SELECT *, sum(entered::INT) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, posicao_id ROWS UNBOUNDED PRECEDING) AS visit FROM t WHERE fence IS NOT NULL),
m AS (SELECT user_id, visit, (epoch(max(ts)) - epoch(min(ts))) / 60 AS minutes FROM v GROUP BY 1, 2) SELECT 'CLIENTE' AS geocerca_tipo, count(*) AS total_visitas, round(avg(minutes), 2) AS tempo_medio_parado_minutos FROM m""")
def geofence_dwell(spark, d):
    placed = gold.positions_in_fences(_tracked_positions(spark, d), _fence_rows(spark))
    return metrics.build_metric("tempo_parado_geocercas", {"positions": placed}).drop("processed_at")


# --- reports, sources and the lake ----------------------------------------------------------------------------------


@query("SELECT count(*) AS trips, count(DISTINCT o_custkey) AS drivers, round(CAST(avg((o_orderstatus = 'F')::INT) AS DOUBLE), 6) AS finished FROM orders")
def kpis(spark, d):
    done = (F.col("o_orderstatus") == "F").cast("int")
    return _t(spark, d, "orders").agg(F.count("*").alias("trips"), F.count_distinct("o_custkey").alias("drivers"), F.round(F.avg(done), 6).alias("finished"))


@query("SELECT count(DISTINCT user_id) AS users, true AS near FROM events")
def approximate_distinct(spark, d):
    e = _t(spark, d, "events").agg(F.count_distinct("user_id").alias("users"), F.approx_count_distinct("user_id").alias("about"))
    return e.select("users", (F.abs(F.col("about") - F.col("users")) <= F.greatest(F.lit(2), F.col("users") * 0.15)).alias("near"))


@query("""WITH r AS (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / 20 AS w FROM lineitem)
SELECT least(floor((l_quantity - lo) / w), 19)::INT AS bin, any_value(lo + least(floor((l_quantity - lo) / w), 19) * w) AS low, count(*) AS total FROM lineitem, r GROUP BY 1""")
def value_histogram(spark, d):
    return reporting.histogram(_t(spark, d, "lineitem"), "l_quantity")


@query("SELECT 'c_nationkey' AS \"column\", count(*) FILTER (c_nationkey IS NULL) AS nulls, count(DISTINCT c_nationkey) AS distinct_values, count(*) AS total FROM customer UNION ALL SELECT 'c_mktsegment', count(*) FILTER (c_mktsegment IS NULL), count(DISTINCT c_mktsegment), count(*) FROM customer")
def profile_nulls(spark, d):
    return reporting.profile(_t(spark, d, "customer"), ["c_nationkey", "c_mktsegment"])


_STATS = "count(v) AS total, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS low, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS high"


@query(f"""WITH s AS (SELECT 'value' AS "column", {_STATS} FROM (SELECT value AS v FROM events) UNION ALL SELECT 'event_id', {_STATS} FROM (SELECT event_id::DOUBLE AS v FROM events))
SELECT "column", total, round(mean, 6) AS mean, round(std, 6) AS std, low, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, high FROM s""")
def profile_describe(spark, d):
    out = reporting.describe(_t(spark, d, "events"), ["value", "event_id"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query("SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'CD (Centro de Distribuição)' WHEN 1 THEN 'Cliente' WHEN 2 THEN 'Pedágio' WHEN 3 THEN 'Posto de Combustível' ELSE n_name END AS label FROM nation")
def label_chain(spark, d):
    kind = F.col("n_nationkey") % 5
    value = F.when(kind == 0, "CENTRO_DISTRIBUICAO").when(kind == 1, "CLIENTE").when(kind == 2, "PEDAGIO").when(kind == 3, "POSTO_COMBUSTIVEL").otherwise(F.col("n_name"))
    return _t(spark, d, "nation").select("n_nationkey", reporting.fence_label(value).alias("label"))


@query("SELECT event_type, count(*) AS total FROM events GROUP BY 1")
def value_counts(spark, d):
    return reporting.value_counts(_t(spark, d, "events"), "event_type")


@query("SELECT c_acctbal >= 0 AS valid, count(*) AS total FROM customer GROUP BY 1")
def serving_split(spark, d):
    rows = _t(spark, d, "customer").withColumn("known", F.when(F.col("c_acctbal") >= 0, F.col("c_name")))
    good, bad = reporting.split_valid(rows, "known", "c_custkey")
    return good.select(F.lit(True).alias("valid")).unionAll(bad.select(F.lit(False).alias("valid"))).groupBy("valid").agg(F.count("*").alias("total"))


@query("SELECT s AS status, count(*) AS total FROM (SELECT o_orderstatus AS s FROM orders) WHERE s IN ('F', 'P') GROUP BY 1")
def partition_filter(spark, d):
    return reporting.value_counts(reporting.selected(_t(spark, d, "orders").select(F.col("o_orderstatus").alias("status")), "status", ["F", "P"]), "status")


def _scratch(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share; it goes when this process ends."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir")
    if not shared and not sc.master.startswith("local") or sc.master.startswith("local-cluster") and not shared:
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    path = f"{shared.rstrip('/')}/lake-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="lake-")
    atexit.register(lambda: sc._jsc is not None and lake.remove(spark, path))
    return path


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 1")
def partition_roundtrip(spark, d):
    """Two dates, one of them written twice: the last write of a date is what it holds, the other date is untouched."""
    path = f"{_scratch(spark)}/nation"
    rows = _t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    lake.write_partition(rows, path, "2024-01-01")
    lake.write_partition(rows.where("n_regionkey = 1"), path, "2024-01-02")
    lake.write_partition(rows.where("n_regionkey <> 1"), path, "2024-01-01")
    lake.mark_processed(spark, path, "2024-01-01")
    assert lake.is_processed(spark, path, "2024-01-01") and not lake.is_processed(spark, path, "2024-01-02")
    return lake.read_partition(spark, path, "2024-01-01").select("n_nationkey", "n_name")


@query("SELECT '2024-01-01' AS ingest_date UNION SELECT '2024-01-02'")
def partition_list(spark, d):
    path, rows = f"{_scratch(spark)}/region", _t(spark, d, "region")
    for day in ("2024-01-01", "2024-01-02"):
        lake.write_partition(rows, path, day)
    return reporting.partitions([spark.read.parquet(path), spark.read.parquet(path)])


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def csv_scan(spark, d):
    path = f"{_scratch(spark)}/nation_csv"
    lake.write_csv(_t(spark, d, "nation").select("n_nationkey", "n_name"), path)
    return registry.scan(spark, registry.Source("nation", "csv", path))


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def json_scan(spark, d):
    path = f"{_scratch(spark)}/nation_json"
    _t(spark, d, "nation").select("n_nationkey", "n_name").write.json(path)
    return registry.scan(spark, registry.Source("nation", "json", path, {"multiLine": "false"}))


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR END AS n_regionkey FROM nation")
def json_multiline_scan(spark, d):
    """An array of objects over many lines, as text; a key that some objects lack is null there."""
    path = f"{_scratch(spark)}/nation_array"
    region = F.when(F.col("n_regionkey") > 1, F.col("n_regionkey"))
    one = F.to_json(F.struct("n_nationkey", "n_name", region.alias("n_regionkey")), {"pretty": "true"})
    whole = _t(spark, d, "nation").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(one), ",\n"), F.lit("\n]")).alias("value"))
    whole.write.text(path)
    return registry.scan(spark, registry.Source("nation", "json", path)).select("n_nationkey", "n_name", "n_regionkey")


@query("""SELECT 'G' || n_nationkey AS geocerca_id, n_name AS nome, n_regionkey::VARCHAR AS uf,
  '{"type":"Polygon","coordinates":[[[' || n_nationkey || '.0,1.5],[2.0,' || n_regionkey || '.0]]]}' AS geometry FROM nation""")
def geojson_scan(spark, d):
    """A feature collection in one file, scanned and flattened."""
    path = f"{_scratch(spark)}/fences"
    k, r = F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double")
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(F.array(k, F.lit(1.5)), F.array(F.lit(2.0), r))).alias("coordinates"))
    named = F.struct(F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("geocerca_id"), F.col("n_name").alias("nome"), F.col("n_regionkey").alias("uf"))
    feature = F.struct(F.lit("Feature").alias("type"), named.alias("properties"), shape.alias("geometry"))
    whole = _t(spark, d, "nation").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features")), {"pretty": "true"}).alias("value"))
    whole.write.text(path)
    return geofence.flatten_features(registry.scan(spark, registry.Source("fences", "geojson", path)), ["geocerca_id", "nome", "uf"])


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, true AS named, true AS stamped FROM nation")
def raw_ingest(spark, d):
    """A CSV source into its raw partition: lineage columns, counted rows, a marker, and the path of the layer."""
    root = _scratch(spark)
    path = lake.Lake(f"{root}/").path("raw", "nation")
    assert path == f"{root}/raw/nation"
    lake.write_csv(_t(spark, d, "nation").select("n_nationkey", "n_name"), f"{root}/nation_csv")
    done = registry.ingest(spark, registry.Source("nation", "csv", f"{root}/nation_csv"), path, "2024-01-01")
    assert lake.is_processed(spark, path, "2024-01-01") and done["records"] == _t(spark, d, "nation").count()
    raw = lake.read_partition(spark, path, "2024-01-01")
    return raw.select("n_nationkey", "n_name", F.endswith("source_file", F.lit("nation_csv")).alias("named"), F.col("ingested_at").isNotNull().alias("stamped"))


@query("SELECT r_regionkey, r_name, day AS ingest_date FROM region, (VALUES ('2024-01-01'), ('2024-01-02')) v(day)")
def whole_table(spark, d):
    """All partitions of a table; a table that is not there is None."""
    path = f"{_scratch(spark)}/region"
    for day in ("2024-01-01", "2024-01-02"):
        lake.write_partition(_t(spark, d, "region").select("r_regionkey", "r_name"), path, day)
    assert lake.read_table(spark, f"{path}_missing") is None
    return lake.read_table(spark, path).withColumn("ingest_date", F.col("ingest_date").cast("string"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey < 3 THEN 'missing' WHEN n_nationkey >= 100 THEN 'unexpected' ELSE 'changed' END AS kind FROM (SELECT n_nationkey FROM nation UNION ALL SELECT n_nationkey + 100 FROM nation WHERE n_nationkey < 2) WHERE n_nationkey < 3 OR n_nationkey >= 100 OR n_nationkey % 5 = 0")
def golden_diff(spark, d):
    left = _t(spark, d, "nation").select("n_nationkey", "n_name")
    name = F.when(F.col("n_nationkey") % 5 == 0, "other").otherwise(F.col("n_name"))
    right = left.where("n_nationkey >= 3").withColumn("n_name", name).unionAll(left.where("n_nationkey < 2").withColumn("n_nationkey", (F.col("n_nationkey") + 100).cast("int")))
    return reporting.keyed_difference(left, right, ["n_nationkey"])
