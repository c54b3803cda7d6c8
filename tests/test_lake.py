import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.plans import pipeline, tables
from waybill.sources import lake, registry
from waybill.streaming.cleaning import clean_stream

DAY = "2026-07-04"


def sources(root):
    (root / "veiculos").mkdir(parents=True)
    (root / "veiculos/veiculos.csv").write_text(
        "veiculo_id,placa,marca,modelo,ano_fabricacao,tipo,capacidade_kg,capacidade_paletes,km_atual,status,data_ultima_revisao\n"
        "VEI-1,ABC1D23,Volvo,FH,2020,Bitrem,1000,20,5,ativo,2024-01-01\nVEI-2,XX,Volvo,FH,2020,Bitrem,1000,20,5,ativo,2024-01-01\n,ABC1D23,v,m,1,VUC,1,1,1,ativo,2024-01-01\n"
    )
    (root / "motoristas").mkdir()
    (root / "motoristas/motoristas.json").write_text(json.dumps([{"motorista_id": "M1", "nome": "Ana", "cpf": "246.813.579-28", "cnh": "12345678901", "categoria_cnh": "C", "validade_cnh": "2027-01-01", "telefone": "81 3456 7890", "data_admissao": "2020-01-01", "base_operacional": "CD", "status": "ativo"}]))
    (root / "geocercas").mkdir()
    box = lambda x: {"type": "Polygon", "coordinates": [[[x, -10], [x + 1, -10], [x + 1, -9], [x, -9], [x, -10]]]}
    feature = lambda i, shape: {"type": "Feature", "properties": {"geocerca_id": i, "nome": i, "tipo": "cliente", "uf": "PE", "raio_km": 1.5, "ativo": True}, "geometry": shape}
    (root / "geocercas/geocercas.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("G1", box(-40)), feature("G2", box(-37)), feature("G3", None)]}))
    (root / "viagens").mkdir()
    trip = {"viagem_id": "T1", "veiculo_id": "VEI-1", "motorista_id": "M1", "geocerca_origem_id": "G1", "geocerca_destino_id": "G2", "data_inicio": "2026-07-01 08:00:00", "data_fim_prevista": "2026-07-01 12:00:00", "data_fim_real": "2026-07-01 13:00:00", "status": "concluida", "distancia_km": 10, "peso_carga_kg": 0, "nota_fiscal": "N1"}
    (root / "viagens/viagens.json").write_text(json.dumps([trip, trip | {"viagem_id": "T2", "nota_fiscal": "N2", "veiculo_id": "VEI-2"}]))


def positions(spark, root):
    at = lambda m: dt.datetime(2026, 7, 1, 8, m)
    rows = [("P1", "T1", "VEI-1", -9.5, -39.5, at(0), 30, True, 1.0), ("P2", "T1", "VEI-1", -9.5, -39.4, at(30), 40, True, 1.0), ("P3", "T1", "VEI-1", -9.5, -38.5, at(40), 50, True, 1.0), ("P4", "T1", "VEI-1", 0.0, 0.0, at(50), 999, True, 1.0)]
    spark.createDataFrame(rows, "posicao_id string, viagem_id string, veiculo_id string, latitude double, longitude double, timestamp timestamp, velocidade_kmh int, ignicao boolean, odometro_metros double").write.parquet(str(root / "rastreamento/posicoes.parquet"))


def test_pipeline_from_files_to_metrics(spark, tmp_path):
    data, store = tmp_path / "data", lake.Lake(str(tmp_path / "lake"))
    sources(data)
    positions(spark, data)
    done = pipeline.run_pipeline(spark, str(data), DAY, store)
    assert done["raw.veiculos"]["records"] == 3
    assert done["staging.veiculos"] == {"approved": 1, "rejected": 1, "rejected_pct": 33.33, "reasons": {"invalid_plate": 1}, "input": 3, "keyless": 1}
    assert done["staging.geocercas"]["reasons"] == {"missing_geometry": 1}
    assert done["staging.posicoes"]["reasons"] == {"speed_above_limit": 1, "zeroed_latitude": 1, "zeroed_longitude": 1}
    read = lambda name: [tuple(r)[:-1] for r in lake.read_partition(spark, store.path("analytics", name), DAY).collect()]
    assert read("viagens_por_mes_status") == [("2026-07", "CONCLUIDA", 1)]
    assert read("tempo_medio_por_rota") == [("G1", "G2", "G1", "G2", 5.0, 1)]
    assert read("taxa_atraso_mensal") == [("2026-07", 1, 1, 1.0)]
    assert read("utilizacao_frota_mensal") == [("2026-07", 1, 1, 1.0)]
    assert read("tempo_parado_geocercas") == [("CLIENTE", 1, 30.0)]
    assert read("top_motoristas") == [(1, "M1", "ANA", 1)]
    assert pipeline.run_pipeline(spark, str(data), DAY, store) == {}  # all marked
    again = pipeline.run_pipeline(spark, str(data), "2026-07-05", store)
    assert again["raw.veiculos"]["records"] == 3
    assert spark.read.parquet(store.path("staging", "veiculos")).count() == 2


def test_partitions_markers_and_registry(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4)
    for n, day in ((4, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-01")):
        lake.write_partition(df.limit(n), path, day)
    assert lake.read_partition(spark, path, "2024-01-01").count() == 3 and lake.read_partition(spark, path, "2024-01-02").count() == 2
    assert not lake.is_processed(spark, path, "2024-01-01")
    lake.mark_processed(spark, path, "2024-01-01")
    assert lake.is_processed(spark, path, "2024-01-01") and lake.read_partition(spark, path, "2024-01-01").columns == ["id"]
    assert lake.read_table(spark, str(tmp_path / "none")) is None and lake.read_table(spark, path).count() == 5
    with pytest.raises(ValueError):
        registry.source("nope")
    with pytest.raises(ValueError):
        registry.scan(spark, registry.Source("x", "xml", "p"))
    assert registry.source("veiculos", "/d").path == "/d/veiculos/veiculos.csv" and "posicoes" in registry.active_sources()
    assert pipeline.ingest_date_of("2024-01-01") == "2024-01-01" and pipeline.ingest_date_of(None, dt.datetime(2024, 2, 3)) == "2024-02-03"


def test_one_partition_is_read(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    for day in ("2024-01-01", "2024-01-02"):
        lake.write_partition(spark.range(2), path, day)
    lake.read_partition(spark, path, "2024-01-02").explain("formatted")
    assert "PartitionFilters: [isnotnull(ingest_date" in capsys.readouterr().out


def test_stream_lands_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    contract = tables.STAGING["posicoes"]
    names = [c.name for c in contract.plain if c.name not in ("dq_observations", "quality_ok", "processed_at", "ingested_at")]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("ingested_at", T.TimestampType())])
    row = {n: "x" for n in names} | {"latitude": "-9", "longitude": "-39", "timestamp": "2026-07-01 10:00:00", "velocidade_kmh": "10", "odometro_metros": "1", "ingested_at": dt.datetime(2026, 7, 4)}
    for i in range(2):
        spark.createDataFrame([row | {"posicao_id": f"P{i}"}, row | {"posicao_id": f"Q{i}", "velocidade_kmh": "-1"}], schema).write.mode("append").json(src)
        for _ in range(2):  # the second run finds nothing new
            clean_stream(spark, src, schema, contract, out, state, "timestamp").awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r["posicao_id"] for r in got.collect()) == ["P0", "P1"]
    assert {str(r["ingest_date"]) for r in got.select(F.col("ingest_date")).collect()} == {"2026-07-01"}
