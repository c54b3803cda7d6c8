import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waybill.functions import geometry
from waybill.operators import contracts, geofence, metrics, quality, reporting, sequences, treatments
from waybill.operators.contracts import Check, ColumnSpec, ContractError, TableContract
from waybill.plans import gold, tables
from waybill.plans.pipeline import clean


def flags(df, key):
    return {r[key]: (r["dq_observations"], r["quality_ok"]) for r in df.collect()}


def raw(spark, names, rows):
    schema = ", ".join(f"{n} string" for n in names.split()) + ", source_file string, ingested_at timestamp"
    return spark.createDataFrame([(*r, "f", dt.datetime(2026, 7, 4)) for r in rows], schema)


def test_vehicles(spark):
    df = raw(spark, "veiculo_id placa marca modelo ano_fabricacao tipo capacidade_kg capacidade_paletes km_atual status data_ultima_revisao extra", [
        (" vei-1 ", "abc1d23", "volvo", "fh", "2020", " Bitrem ", "1000", "20", "5", "ativo", "2024-01-01", "x"), ("VEI-2", "bad", "v", "m", "dirty", "BITREM", "1", "1", "-4", "ATIVO", "2024-01-01", "x"),
        ("VEI-3", "ABC1234", "v", "m", "2020", "VUC", "1", "1", None, "ATIVO", "", "x"), ("", "ABC1234", "v", "m", "2020", "VUC", "1", "1", "1", "ATIVO", "2024-01-01", "x"),
    ])
    out = contracts.conform(clean(df, tables.STAGING["veiculos"]), tables.STAGING["veiculos"])
    assert "extra" not in out.columns
    assert flags(out, "veiculo_id") == {"VEI-1": ("", True), "VEI-2": ("invalid_plate;invalid_vehicle_type;negative_mileage", False), "VEI-3": ("negative_mileage;missing_revision_date", False)}
    two = out.where("veiculo_id = 'VEI-2'").first()
    assert two["placa"] is None and two["km_atual"] is None and two["ano_fabricacao"] is None and two["tipo"] is None


def test_drivers_keep_one_of_a_repeated_key_and_derive_after_nulling(spark):
    df = raw(spark, "motorista_id nome cpf cnh categoria_cnh validade_cnh telefone data_admissao base_operacional status", [
        ("M1", "a", "246.813.579-28", "12345678901", "c", "2026-01-01", "+55 (071) 2827-1996", "2020-01-01", "x", "ativo"),
        ("M1", "b", "246.813.579-28", "12345678901", "D", "2026-01-01", None, "2020-01-01", "x", "ATIVO"),
        ("M2", " ", "111.111.111-11", None, "E", "2026-01-01", "", "2020-01-01", "x", "ATIVO"),
    ])
    rows = clean(df, tables.STAGING["motoristas"]).collect()
    first, second, bad = next(r for r in rows if r["nome"] == "A"), next(r for r in rows if r["nome"] == "B"), next(r for r in rows if r["motorista_id"] == "M2")
    assert first["dq_observations"] == "" and first["telefone"] == "7128271996" and first["cpf_normalize"] == "24681357928"
    assert second["dq_observations"] == "duplicate_key" and second["motorista_id"] is None
    assert bad["dq_observations"] == "missing_name;invalid_cpf;invalid_cnh" and bad["cpf"] is None and bad["cpf_normalize"] is None


def test_trips_report_unique_reasons_last(spark):
    names = "viagem_id veiculo_id motorista_id geocerca_origem_id geocerca_destino_id data_inicio data_fim_prevista data_fim_real status distancia_km peso_carga_kg nota_fiscal"
    base = lambda i, **kw: tuple(({"viagem_id": i, "veiculo_id": "v", "motorista_id": "m", "geocerca_origem_id": "g", "geocerca_destino_id": "h", "data_inicio": "2026-01-01 10:00:00", "data_fim_prevista": None, "data_fim_real": None, "status": "CONCLUIDA", "distancia_km": "5", "peso_carga_kg": "0", "nota_fiscal": f"NF{i}"} | kw)[n] for n in names.split())
    df = raw(spark, names, [base("1"), base("2", data_inicio=None), base("3", distancia_km="-1"), base("4", nota_fiscal="NF1", peso_carga_kg="-2"), base("5", nota_fiscal=""), base("6", nota_fiscal=None)])
    out = clean(df, tables.STAGING["viagens"])
    assert {k: v[0] for k, v in flags(out, "viagem_id").items()} == {"1": "", "2": "missing_start_date", "3": "invalid_distance", "4": "negative_cargo_weight;duplicate_invoice", "5": "missing_invoice", "6": "missing_invoice"}


def test_positions_null_fails_and_nulling_cascades(spark):
    df = raw(spark, "posicao_id viagem_id veiculo_id latitude longitude timestamp velocidade_kmh ignicao odometro_metros", [
        ("P1", "V", "C", "-8.0", "-35.0", "2026-04-28 21:34:58.588212", "150", "true", "1.0"), ("P2", "V", "C", "0", "0", "2026-04-28", "999", "sim", "1.0"),
        ("P3", "V", "C", "0", "-50", "2026-04-28", None, "true", "-1"), ("P4", "", None, "50", "-50", "bad", "10", "true", "1"),
    ])
    out = clean(df, tables.STAGING["posicoes"])
    got = flags(out, "posicao_id")
    assert got["P1"] == ("", True)
    assert got["P2"][0] == "zeroed_latitude;zeroed_longitude;speed_above_limit"
    assert got["P3"][0] == "zeroed_latitude;negative_speed;speed_above_limit;negative_odometer"
    assert got["P4"][0] == "missing_trip_id;missing_vehicle_id;coordinates_outside_brazil;missing_timestamp"
    assert out.where("posicao_id = 'P2'").first()["ignicao"] is None
    cascaded = out.where("posicao_id = 'P3'").first()
    assert cascaded["latitude"] is None and cascaded["longitude"] is None  # the pair check sees the nulled latitude


def test_pair_check_sees_the_nulled_cell(spark):
    pair = ("latitude", "longitude")
    c = TableContract("t", (ColumnSpec("latitude", "double", validations=(Check("non_zero", "zero"), Check("coordinates_in_brazil", "out", pair, pair))), ColumnSpec("longitude", "double")))
    row = quality.validate(spark.createDataFrame([(0.0, -50.0)], "latitude double, longitude double"), c).first()
    assert (row["latitude"], row["longitude"]) == (None, None)


def test_contract_errors(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(ContractError, match="name is missing|x is missing"):
        contracts.conform(df, TableContract("t", (ColumnSpec("x", "int"),)))
    with pytest.raises(ContractError, match="not bigint"):
        contracts.conform(df, TableContract("t", (ColumnSpec("id", "bigint"),)))
    with pytest.raises(ContractError, match="no check"):
        quality.validate(df, TableContract("t", (ColumnSpec("id", "int", validations=(Check("nope", "r"),)),)))
    with pytest.raises(ContractError, match="needs"):
        quality.validate(df, TableContract("t", (ColumnSpec("id", "int", validations=(Check("required", "r", ("gone",)),)),)))
    with pytest.raises(ContractError, match="no treatment"):
        treatments.apply_treatments(df, TableContract("t", (ColumnSpec("id", "int", False, ("nope",)),)))


def test_contract_json_round_trip(tmp_path):
    data = {"table_name": "t", "description": "d", "partitioned_by": ["ingest_date"], "schema": [{"name": "a", "type": "string", "key": True, "treatments": ["trim"], "validations": [{"check": "unique", "reason": "dup", "columns": ["a"], "null_columns": ["a"]}]}, {"name": "a", "type": "string", "new_name": "b"}]}
    (tmp_path / "c.json").write_text(json.dumps(data))
    c = contracts.load(str(tmp_path / "c.json"))
    assert c.keys == ("a",) and c.columns[0].validations == (Check("unique", "dup", ("a",), ("a",)),) and [x.output for x in c.columns] == ["a", "b"]


def test_reports(spark):
    df = spark.createDataFrame([("", True), ("b;a", False), ("b", False), ("a", None)], "dq_observations string, quality_ok boolean")
    good, bad = quality.split_by_quality(df)
    assert good.count() == 1 and bad.count() == 3
    assert [tuple(r) for r in quality.rejection_histogram(bad).collect()] == [("a", 2), ("b", 2)]
    assert quality.rejection_metrics(df) == {"approved": 1, "rejected": 3, "rejected_pct": 75.0, "reasons": {"a": 2, "b": 2}}


FENCES = [("A", "Box", "CLIENTE", "SP", 5.0, True, (0, 0, 2, 2), True), ("B", "Small", "PEDAGIO", "SP", 1.0, True, (1, 1, 4, 4), True), ("C", "Off", "CLIENTE", "SP", 0.1, False, (0, 0, 9, 9), True), ("D", "Null", "CLIENTE", "SP", None, True, (8, 8, 9, 9), True)]


def fences(spark):
    shape = lambda a, b, c, d: '{"type":"Polygon","coordinates":[[[%s,%s],[%s,%s],[%s,%s],[%s,%s],[%s,%s]]]}' % (a, b, c, b, c, d, a, d, a, b)
    rows = [(*f[:6], shape(*f[6]), f[7]) for f in FENCES]
    return spark.createDataFrame(rows, "geocerca_id string, nome string, tipo string, uf string, raio_km double, ativo boolean, geometry string, quality_ok boolean")


def test_positions_events_and_dwell(spark):
    at = lambda m: dt.datetime(2026, 1, 1, 10, m)
    track = [("1", 0.5, 0.0), ("2", 1.5, 1.5), ("3", 3.0, 3.0), ("4", 7.0, 7.0), ("5", 3.0, 3.0), ("6", None, 3.0), ("7", 8.5, 9.0)]
    rows = [(f"P{i}", "V", "C", at(10 * k), y, x, 5, "f", at(0), "", True) for k, (i, x, y) in enumerate(track[:6])] + [("P7", "W", "C", at(0), 9.0, 8.5, 5, "f", at(0), "", True)]
    positions = spark.createDataFrame(rows, "posicao_id string, viagem_id string, veiculo_id string, timestamp timestamp, latitude double, longitude double, velocidade_kmh int, source_file string, ingested_at timestamp, dq_observations string, quality_ok boolean")
    out = gold.positions_in_fences(positions, fences(spark))
    contracts.conform(out, tables.GOLD["posicoes_geocercas"])
    got = {r["posicao_id"]: (r["geocerca_id"], r["evento_entrada_geocerca"], r["evento_saida_geocerca"]) for r in out.collect()}
    assert got == {"P1": ("A", True, False), "P2": ("B", True, True), "P3": ("B", False, False), "P4": (None, False, True), "P5": ("B", True, False), "P6": (None, False, True), "P7": ("D", True, False)}
    dwell = {r["geocerca_tipo"]: (r["total_visitas"], r["tempo_medio_parado_minutos"]) for r in metrics.geofence_dwell(out).collect()}
    assert dwell == {"CLIENTE": (2, 0.0), "PEDAGIO": (2, 5.0)}


def test_matching_finds_all_fences_at_any_cell_size(spark):
    points = spark.createDataFrame([(x / 2, y / 2) for x in range(-2, 22) for y in range(-2, 22)], "x double, y double")
    pairs = Counter((r["x"], r["y"], r["geocerca_id"]) for r in geofence.match_all(points, fences(spark), "x", "y", ["geocerca_id"]).collect())
    want = Counter((x / 2, y / 2, f[0]) for x in range(-2, 22) for y in range(-2, 22) for f in FENCES if f[6][0] <= x / 2 <= f[6][2] and f[6][1] <= y / 2 <= f[6][3])
    assert pairs == want
    assert geofence.match_all(points, fences(spark).where("false"), "x", "y", ["geocerca_id"]).count() == 0


def test_enriched_trips_keep_orphans(spark):
    at = lambda h: dt.datetime(2026, 3, 1, h)
    trips = spark.createDataFrame([
        ("T1", "V1", "D1", "A", "B", at(8), at(12), at(10), "CONCLUIDA", 1, 1, "n", "f", at(0), "", True), ("T2", "V9", None, "A", "Z", at(8), at(9), at(10), "CONCLUIDA", 1, 1, "n", "f", at(0), "x", False),
        ("T3", "V1", "D1", "A", "B", None, None, None, "ATRASADA", 1, 1, "n", "f", at(0), "", True),
    ], "viagem_id string, veiculo_id string, motorista_id string, geocerca_origem_id string, geocerca_destino_id string, data_inicio timestamp, data_fim_prevista timestamp, data_fim_real timestamp, status string, distancia_km int, peso_carga_kg int, nota_fiscal string, source_file string, ingested_at timestamp, dq_observations string, quality_ok boolean")
    vehicles = spark.createDataFrame([("V1", "p", "m", "o", "VUC", 5, "ATIVO"), ("V2", "q", "m", "o", "VUC", 5, "ATIVO"), ("V3", "r", "m", "o", "VUC", 5, "INATIVO")], "veiculo_id string, placa string, marca string, modelo string, tipo string, capacidade_kg int, status string")
    drivers = spark.createDataFrame([("D1", "Ana", "C", "base", "ATIVO")], "motorista_id string, nome string, categoria_cnh string, base_operacional string, status string")
    positions = spark.createDataFrame([("1", "T1", 10, at(8)), ("2", "T1", 15, at(9)), ("3", None, 99, at(9))], "posicao_id string, viagem_id string, velocidade_kmh int, timestamp timestamp")
    out = gold.enriched_trips(trips, vehicles, drivers, fences(spark), positions)
    rows = {r["viagem_id"]: r for r in contracts.conform(out, tables.GOLD["viagens_enriquecidas"]).collect()}
    assert (rows["T1"]["atraso_horas"], rows["T1"]["atrasada_flag"], rows["T1"]["num_posicoes"], rows["T1"]["velocidade_media_kmh"], rows["T1"]["dq_observations"]) == (-2.0, False, 2, 12.5, "")
    assert rows["T2"]["dq_observations"] == "x;vehicle_not_found;driver_not_found;destination_geofence_not_found" and not rows["T2"]["quality_ok"] and rows["T2"]["atrasada_flag"]
    assert rows["T3"]["atrasada_flag"] and rows["T3"]["mes"] is None and rows["T3"]["num_posicoes"] is None
    frames = {"trips": out, "vehicles": vehicles}
    assert [tuple(r)[:-1] for r in metrics.build_metric("viagens_por_mes_status", frames).collect()] == [("2026-03", "CONCLUIDA", 1)]
    assert [tuple(r)[:-1] for r in metrics.build_metric("utilizacao_frota_mensal", frames).collect()] == [("2026-03", 1, 2, 0.5)]
    assert [tuple(r)[:-1] for r in metrics.build_metric("utilizacao_frota_mensal", frames | {"vehicles": vehicles.where("false")}).collect()] == [("2026-03", 0, 0, None)]
    assert [tuple(r)[:-1] for r in metrics.build_metric("taxa_atraso_mensal", frames).collect()] == [("2026-03", 0, 1, 0.0)]
    assert [tuple(r)[:-1] for r in metrics.build_metric("top_motoristas", frames).collect()] == [(1, "D1", "Ana", 1)]
    assert [tuple(r)[:-1] for r in metrics.build_metric("tempo_medio_por_rota", frames).collect()] == [("A", "B", "Box", "Small", 2.0, 2)]


def test_flattening_tolerates_absent_fields(spark):
    df = spark.createDataFrame([("Feature", {"geocerca_id": "G1"})], "type string, properties struct<geocerca_id:string>")
    row = geofence.flatten_features(df).first()
    assert row["geocerca_id"] == "G1" and row["nome"] is None and row["geometry"] is None


def test_dwell_of_all_kinds_and_differences(spark):
    df = spark.createDataFrame([(1, "f", "K", dt.datetime(2024, 1, 1, 1)), (1, "f", "K", dt.datetime(2024, 1, 1, 2)), (1, None, "Q", dt.datetime(2024, 1, 1, 3))], "u int, fence string, kind string, ts timestamp")
    assert {tuple(r) for r in sequences.dwell_of_all_kinds(df, ["u"], "fence", "kind", "ts", "m").collect()} == {("K", 60.0), ("Q", 0.0)}
    a, b = spark.createDataFrame([(1, 2), (1, 2), (None, 3)], "k int, v int"), spark.createDataFrame([(1, 2), (None, 4), (5, 6)], "k int, v int")
    missing, unexpected = reporting.difference(a, b)
    assert sorted(map(str, missing.collect())) == ["Row(k=1, v=2)", "Row(k=None, v=3)"] and unexpected.count() == 2
    assert {tuple(r) for r in reporting.keyed_difference(a.distinct(), b, ["k"]).collect()} == {(None, "changed"), (5, "unexpected")}


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "x double")
    assert reporting.histogram(empty, "x").count() == 0
    assert reporting.profile(empty).first()["total"] == 0
    assert quality.rejection_metrics(spark.createDataFrame([], "dq_observations string, quality_ok boolean"))["rejected_pct"] == 0.0


def test_first_of_a_hot_key_and_of_equal_rows(spark):
    """A key of half the rows, spread over many partitions, with rows that are equal in all their values."""
    rows = [("hot", i % 40, "x") for i in range(2000)] + [("hot", None, "x")] + [(f"k{i}", 1, "y") for i in range(1000)] + [("k5", 0, "z"), ("", 1, "a"), ("", 1, "a"), (None, 1, "b")]
    df = spark.createDataFrame(rows, "k string, n int, s string")
    for parts in (1, 7, 50):
        marked = quality.mark_first(df.repartition(parts), ["k"], ["n"], "first")
        assert marked.columns == ["k", "n", "s", "first"]
        got = [tuple(r) for r in marked.collect()]
        assert len(got) == len(rows)
        assert sorted(r[:3] for r in got if r[3] and r[0]) == sorted([("hot", 0, "x"), ("k5", 0, "z")] + [(f"k{i}", 1, "y") for i in range(1000) if i != 5])
        assert all(r[3] for r in got if not r[0])
    plan = quality.mark_first(df, ["k"], ["n"], "first")._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan and plan.count("Window") >= 2


def test_edges_of_a_cell_decide_as_all_edges_do(spark):
    """A ring of many edges: its cells keep few of them, and every point is judged as by the whole ring."""
    import math

    ring = [(round(50 + 40 * math.cos(i / 60 * math.pi) * (1 + 0.3 * (i % 2)), 3), round(50 + 40 * math.sin(i / 60 * math.pi) * (1 + 0.3 * (i % 2)), 3)) for i in range(120)]
    shape = '{"type":"Polygon","coordinates":[[%s]]}' % ",".join(f"[{x},{y}]" for x, y in [*ring, ring[0]])
    small = '{"type":"Polygon","coordinates":[[[10,10],[12,10],[12,12],[10,12],[10,10]]]}'
    fences = spark.createDataFrame([("star", shape), ("box", small)], "f string, geometry string")
    cells, _ = geofence.candidate_cells(fences, ["f"])
    sizes = [len(f["lines"]) for r in cells.collect() for f in r["fences"] if f["f"] == "star"]
    assert len(sizes) > 4 and max(sizes) < 120
    points = spark.createDataFrame([(float(x) / 2, float(y) / 2) for x in range(0, 220, 3) for y in range(0, 220, 3)], "x double, y double")
    got = {(r["x"], r["y"]) for r in geofence.match_all(points, fences, "x", "y", ["f"]).where("f = 'star'").collect()}
    lines = geometry.edges(F.lit(shape))
    want = {(r["x"], r["y"]) for r in points.where(geometry.contains(F.col("x"), F.col("y"), lines)).collect()}
    assert got == want and len(want) > 100


def test_retries():
    from waybill.plans.pipeline import with_retries

    calls, waits = [], []

    def f(x, fail):
        calls.append(x)
        if len(calls) <= fail:
            raise OSError(x)
        return x

    assert with_retries(f, 7, fail=2, sleep=waits.append) == 7 and len(calls) == 3 and waits == [60.0, 60.0]
    calls.clear()
    try:
        with_retries(f, 1, fail=9, retries=1, delay=0.5, sleep=waits.append)
    except OSError:
        assert len(calls) == 2 and waits[-1] == 0.5
    else:
        raise AssertionError
