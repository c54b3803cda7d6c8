"""The contracts of the staging and gold tables."""

from __future__ import annotations

from ..operators.contracts import Check, ColumnSpec, TableContract

# Names, types, treatments, checks and rejection reasons of all tables.

LINEAGE = (ColumnSpec("source_file", "string"), ColumnSpec("ingested_at", "timestamp"))
INGESTED = LINEAGE[1:]
QUALITY = (ColumnSpec("dq_observations", "string"), ColumnSpec("quality_ok", "boolean"))
PROCESSED = (ColumnSpec("processed_at", "timestamp"),)

STAGING = {
    "veiculos": TableContract("staging_veiculos", (
        ColumnSpec("veiculo_id", "string", key=True, treatments=("normalize",), validations=(Check("unique", "duplicate_key"),)),
        ColumnSpec("placa", "string", treatments=("normalize",), validations=(Check("plate_is_valid", "invalid_plate"),)),
        ColumnSpec("marca", "string", treatments=("normalize",)),
        ColumnSpec("modelo", "string", treatments=("normalize",)),
        ColumnSpec("ano_fabricacao", "int"),
        ColumnSpec("tipo", "string", treatments=("trim",), validations=(Check("vehicle_type_is_valid", "invalid_vehicle_type"),)),
        ColumnSpec("capacidade_kg", "int"),
        ColumnSpec("capacidade_paletes", "int"),
        ColumnSpec("km_atual", "int", validations=(Check("non_negative", "negative_mileage"),)),
        ColumnSpec(
            "status", "string", treatments=("normalize",),
            validations=(Check("vehicle_status_is_valid", "invalid_status"),),
        ),
        ColumnSpec(
            "data_ultima_revisao", "date", treatments=("parse_date",),
            validations=(Check("required", "missing_revision_date"),),
        ),
        *LINEAGE, *QUALITY, *PROCESSED,
    )),
    "motoristas": TableContract("staging_motoristas", (
        ColumnSpec("motorista_id", "string", key=True, treatments=("normalize",), validations=(Check("unique", "duplicate_key"),)),
        ColumnSpec("nome", "string", treatments=("normalize",), validations=(Check("required", "missing_name"),)),
        ColumnSpec("cpf", "string", treatments=("trim",), validations=(Check("cpf_is_valid", "invalid_cpf"),)),
        ColumnSpec("cpf", "string", treatments=("normalize_cpf",), new_name="cpf_normalize"),
        ColumnSpec("cnh", "string", treatments=("trim",), validations=(Check("cnh_is_valid", "invalid_cnh"),)),
        ColumnSpec(
            "categoria_cnh", "string", treatments=("normalize",),
            validations=(Check("cnh_category_is_valid", "invalid_cnh_category"),),
        ),
        ColumnSpec("validade_cnh", "date", treatments=("parse_date",), validations=(Check("required", "missing_cnh_expiry"),)),
        ColumnSpec("telefone", "string", treatments=("trim", "normalize_telefone",)),
        ColumnSpec("data_admissao", "date", treatments=("parse_date",), validations=(Check("required", "missing_admission_date"),)),
        ColumnSpec("base_operacional", "string", treatments=("trim",)),
        ColumnSpec("status", "string", treatments=("normalize",), validations=(Check("driver_status_is_valid", "invalid_status"),)),
        *INGESTED, *QUALITY, *PROCESSED,
    )),
    "geocercas": TableContract("staging_geocercas", (
        ColumnSpec("geocerca_id", "string", key=True, treatments=("normalize",), validations=(Check("unique", "duplicate_key"),)),
        ColumnSpec("nome", "string", treatments=("trim",), validations=(Check("required", "missing_name"),)),
        ColumnSpec(
            "tipo", "string", treatments=("normalize",),
            validations=(Check("geofence_type_is_valid", "invalid_geofence_type"),),
        ),
        ColumnSpec("uf", "string", treatments=("normalize",)),
        ColumnSpec("raio_km", "double", validations=(Check("positive", "invalid_radius"),)),
        ColumnSpec("ativo", "boolean", validations=(Check("required", "invalid_active_flag"),)),
        ColumnSpec(
            "geometry", "string",
            validations=(Check("required", "missing_geometry"), Check("geojson_polygon_is_valid", "invalid_geometry"), Check("geojson_polygon_is_in_brazil", "geometry_outside_brazil"),),
        ),
        *LINEAGE, *QUALITY, *PROCESSED,
    )),
    "viagens": TableContract("staging_viagens", (
        ColumnSpec("viagem_id", "string", key=True, treatments=("normalize",), validations=(Check("unique", "duplicate_key"),)),
        ColumnSpec("veiculo_id", "string", treatments=("normalize",)),
        ColumnSpec("motorista_id", "string", treatments=("normalize",)),
        ColumnSpec("geocerca_origem_id", "string", treatments=("normalize",)),
        ColumnSpec("geocerca_destino_id", "string", treatments=("normalize",)),
        ColumnSpec("data_inicio", "timestamp", treatments=("parse_date",), validations=(Check("required", "missing_start_date"),)),
        ColumnSpec("data_fim_prevista", "timestamp", treatments=("parse_date",)),
        ColumnSpec("data_fim_real", "timestamp", treatments=("parse_date",)),
        ColumnSpec("status", "string", treatments=("normalize",), validations=(Check("trip_status_is_valid", "invalid_status"),)),
        ColumnSpec("distancia_km", "int", validations=(Check("positive", "invalid_distance"),)),
        ColumnSpec("peso_carga_kg", "int", validations=(Check("non_negative", "negative_cargo_weight"),)),
        ColumnSpec(
            "nota_fiscal", "string", treatments=("normalize",),
            validations=(Check("required", "missing_invoice"), Check("unique", "duplicate_invoice"),),
        ),
        *LINEAGE, *QUALITY, *PROCESSED,
    )),
    "posicoes": TableContract("staging_posicoes", (
        ColumnSpec("posicao_id", "string", key=True, treatments=("normalize",), validations=(Check("unique", "duplicate_key"),)),
        ColumnSpec("viagem_id", "string", treatments=("normalize",), validations=(Check("required", "missing_trip_id"),)),
        ColumnSpec("veiculo_id", "string", treatments=("normalize",), validations=(Check("required", "missing_vehicle_id"),)),
        ColumnSpec(
            "latitude", "double",
            validations=(Check("non_zero", "zeroed_latitude"), Check("coordinates_in_brazil", "coordinates_outside_brazil", ("latitude", "longitude")),),
        ),
        ColumnSpec("longitude", "double", validations=(Check("non_zero", "zeroed_longitude"),)),
        ColumnSpec("timestamp", "timestamp", treatments=("parse_date",), validations=(Check("required", "missing_timestamp"),)),
        ColumnSpec(
            "velocidade_kmh", "int",
            validations=(Check("non_negative", "negative_speed"), Check("speed_within_limit", "speed_above_limit"),),
        ),
        ColumnSpec("ignicao", "boolean"),
        ColumnSpec("odometro_metros", "double", validations=(Check("non_negative", "negative_odometer"),)),
        *LINEAGE, *QUALITY, *PROCESSED,
    )),
}

GOLD = {
    "posicoes_geocercas": TableContract("analytics_posicoes_geocercas", (
        ColumnSpec("posicao_id", "string"),
        ColumnSpec("viagem_id", "string"),
        ColumnSpec("veiculo_id", "string"),
        ColumnSpec("timestamp", "timestamp"),
        ColumnSpec("latitude", "double"),
        ColumnSpec("longitude", "double"),
        ColumnSpec("velocidade_kmh", "int"),
        ColumnSpec("geocerca_id", "string"),
        ColumnSpec("geocerca_nome", "string"),
        ColumnSpec("geocerca_tipo", "string"),
        ColumnSpec("classificacao_localizacao", "string"),
        ColumnSpec("evento_entrada_geocerca", "boolean"),
        ColumnSpec("evento_saida_geocerca", "boolean"),
        *LINEAGE, *QUALITY, *PROCESSED,
    )),
    "viagens_enriquecidas": TableContract("analytics_viagens_enriquecidas", (
        ColumnSpec("viagem_id", "string"),
        ColumnSpec("veiculo_id", "string"),
        ColumnSpec("motorista_id", "string"),
        ColumnSpec("geocerca_origem_id", "string"),
        ColumnSpec("geocerca_destino_id", "string"),
        ColumnSpec("data_inicio", "timestamp"),
        ColumnSpec("data_fim_prevista", "timestamp"),
        ColumnSpec("data_fim_real", "timestamp"),
        ColumnSpec("status", "string"),
        ColumnSpec("distancia_km", "int"),
        ColumnSpec("peso_carga_kg", "int"),
        ColumnSpec("nota_fiscal", "string"),
        ColumnSpec("veiculo_placa", "string"),
        ColumnSpec("veiculo_marca", "string"),
        ColumnSpec("veiculo_modelo", "string"),
        ColumnSpec("veiculo_tipo", "string"),
        ColumnSpec("veiculo_capacidade_kg", "int"),
        ColumnSpec("veiculo_status", "string"),
        ColumnSpec("motorista_nome", "string"),
        ColumnSpec("motorista_categoria_cnh", "string"),
        ColumnSpec("motorista_base_operacional", "string"),
        ColumnSpec("motorista_status", "string"),
        ColumnSpec("origem_nome", "string"),
        ColumnSpec("origem_tipo", "string"),
        ColumnSpec("origem_uf", "string"),
        ColumnSpec("destino_nome", "string"),
        ColumnSpec("destino_tipo", "string"),
        ColumnSpec("destino_uf", "string"),
        ColumnSpec("velocidade_media_kmh", "double"),
        ColumnSpec("num_posicoes", "bigint"),
        ColumnSpec("primeira_posicao_ts", "timestamp"),
        ColumnSpec("ultima_posicao_ts", "timestamp"),
        ColumnSpec("duracao_horas", "double"),
        ColumnSpec("duracao_prevista_horas", "double"),
        ColumnSpec("atraso_horas", "double"),
        ColumnSpec("atrasada_flag", "boolean"),
        ColumnSpec("mes", "string"),
        *LINEAGE, *QUALITY, *PROCESSED,
    )),
    "viagens_por_mes_status": TableContract("analytics_viagens_por_mes_status", (
        ColumnSpec("mes", "string"),
        ColumnSpec("status", "string"),
        ColumnSpec("total_viagens", "bigint"),
        *PROCESSED,
    )),
    "tempo_medio_por_rota": TableContract("analytics_tempo_medio_por_rota", (
        ColumnSpec("geocerca_origem_id", "string"),
        ColumnSpec("geocerca_destino_id", "string"),
        ColumnSpec("origem_nome", "string"),
        ColumnSpec("destino_nome", "string"),
        ColumnSpec("tempo_medio_horas", "double"),
        ColumnSpec("total_viagens", "bigint"),
        *PROCESSED,
    )),
    "taxa_atraso_mensal": TableContract("analytics_taxa_atraso_mensal", (
        ColumnSpec("mes", "string"),
        ColumnSpec("viagens_atrasadas", "bigint"),
        ColumnSpec("viagens_total", "bigint"),
        ColumnSpec("taxa_atraso", "double"),
        *PROCESSED,
    )),
    "top_motoristas": TableContract("analytics_top_motoristas", (
        ColumnSpec("posicao_rank", "int"),
        ColumnSpec("motorista_id", "string"),
        ColumnSpec("motorista_nome", "string"),
        ColumnSpec("viagens_concluidas", "bigint"),
        *PROCESSED,
    )),
    "utilizacao_frota_mensal": TableContract("analytics_utilizacao_frota_mensal", (
        ColumnSpec("mes", "string"),
        ColumnSpec("veiculos_com_viagem", "bigint"),
        ColumnSpec("veiculos_ativos_total", "bigint"),
        ColumnSpec("taxa_utilizacao", "double"),
        *PROCESSED,
    )),
    "tempo_parado_geocercas": TableContract("analytics_tempo_parado_geocercas", (
        ColumnSpec("geocerca_tipo", "string"),
        ColumnSpec("total_visitas", "bigint"),
        ColumnSpec("tempo_medio_parado_minutos", "double"),
        *PROCESSED,
    )),
}
