"""Raw to staging to gold for one date: steps in order of their inputs, finished ones skipped, markers written last."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import geofence, quality
from ..operators.contracts import TableContract, conform
from ..operators.metrics import METRICS, build_metric
from ..operators.treatments import apply_treatments, derive
from ..sources import lake, registry
from . import gold, tables


def session(name: str = "waybill", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    return (builder.master(master) if master else builder).getOrCreate()


def run_with_session(f, *args, **kwargs):
    """Call ``f(spark, ...)`` and stop the session whatever happens."""
    spark = session()
    try:
        return f(spark, *args, **kwargs)
    finally:
        spark.stop()


def with_retries(f, *args, retries: int = 2, delay: float = 60.0, sleep=time.sleep, **kwargs):
    """``f``'s result; a call that fails is made again up to ``retries`` times, ``delay`` seconds apart."""
    for left in range(retries, -1, -1):
        try:
            return f(*args, **kwargs)
        except Exception:
            if not left:
                raise
            sleep(delay)


def ingest_date_of(logical: str | None = None, run_after: dt.datetime | None = None) -> str:
    """The date a run is for: its logical date, else the day it may start, else today (UTC)."""
    return logical or (run_after or dt.datetime.now(dt.UTC)).date().isoformat()


def clean(df: DataFrame, contract: TableContract) -> DataFrame:
    """Treat, validate, derive and stamp the rows of a raw table."""
    treated = apply_treatments(df, contract)
    return derive(quality.validate(treated, contract), contract).withColumn("processed_at", F.current_timestamp())


def staging(spark: SparkSession, name: str, raw: DataFrame, path: str, date: str) -> dict:
    """Write the approved rows of a raw partition; the counts, those of the reasons too, come from the same pass."""
    contract = tables.STAGING[name]
    flat = geofence.flatten_features(raw) if name == "geocercas" else raw
    seen, judged = Observation(f"in_{name}"), Observation(f"ok_{name}")
    cleaned = conform(clean(flat.observe(seen, F.count(F.lit(1)).alias("n")), contract), contract)
    ok = F.coalesce(F.col(quality.OK), F.lit(False))
    reasons = quality.reason_counts(contract)
    numbered = [c.alias(f"reason_{i}") for i, c in enumerate(reasons.values())]
    watched = cleaned.observe(judged, F.count_if(ok).alias("approved"), F.count_if(~ok).alias("rejected"), *numbered)
    lake.write_partition(watched.where(ok), path, date)
    counts, total = judged.get, seen.get["n"]
    rejected = counts["rejected"]
    found = {r: counts[f"reason_{i}"] for i, r in enumerate(reasons) if counts[f"reason_{i}"]}
    found = dict(sorted(found.items(), key=lambda x: (-x[1], x[0])))
    metrics = {
        "approved": counts["approved"], "rejected": rejected, "rejected_pct": round(100 * rejected / total, 2) if total else 0.0,
        "reasons": found, "input": total, "keyless": total - counts["approved"] - rejected,
    }
    quality.log_rejections(contract.table_name, metrics)
    lake.mark_processed(spark, path, date)
    return metrics


def _gold(spark: SparkSession, name: str, df: DataFrame, path: str, date: str) -> dict:
    seen = Observation(f"gold_{name}")
    lake.write_partition(conform(df, tables.GOLD[name]).observe(seen, F.count(F.lit(1)).alias("records")), path, date)
    lake.mark_processed(spark, path, date)
    return {"records": seen.get["records"]}


def run_pipeline(spark: SparkSession, data_root: str, date: str, store: lake.Lake | None = None) -> dict[str, dict]:
    """All layers of one date; a step whose marker exists is skipped, and the metrics run together if any is missing."""
    store, done = store or lake.Lake(), {}
    at = lambda layer, name: store.path(layer, name)
    pending = lambda layer, name: not lake.is_processed(spark, at(layer, name), date)
    read = lambda layer, name: lake.read_partition(spark, at(layer, name), date)
    for name in registry.active_sources():
        if pending("raw", name):
            done[f"raw.{name}"] = registry.ingest(spark, registry.source(name, data_root), at("raw", name), date)
        if pending("staging", name):
            done[f"staging.{name}"] = staging(spark, name, read("raw", name), at("staging", name), date)
    if pending("analytics", "posicoes_geocercas"):
        df = gold.positions_in_fences(read("staging", "posicoes"), read("staging", "geocercas"))
        done["analytics.posicoes_geocercas"] = _gold(spark, "posicoes_geocercas", df, at("analytics", "posicoes_geocercas"), date)
    if pending("analytics", "viagens_enriquecidas"):
        df = gold.enriched_trips(*(read("staging", n) for n in ("viagens", "veiculos", "motoristas", "geocercas", "posicoes")))
        done["analytics.viagens_enriquecidas"] = _gold(spark, "viagens_enriquecidas", df, at("analytics", "viagens_enriquecidas"), date)
    if any(pending("analytics", m) for m in METRICS):
        frames = {"trips": read("analytics", "viagens_enriquecidas"), "vehicles": read("staging", "veiculos"), "positions": read("analytics", "posicoes_geocercas")}
        for m in METRICS:
            done[f"analytics.{m}"] = _gold(spark, m, build_metric(m, frames), at("analytics", m), date)
    return done
