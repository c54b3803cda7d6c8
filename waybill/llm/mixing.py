"""Mixing sources to target weights by entropy balancing.

A document of ``size`` words gets the rate ``min(cap, exp(lambda * size / mean size))`` with its source's lambda: of all
rates with the source's target of words and none above the cap, these are closest to one copy each in relative entropy.
Lambda is the root of the dual's gradient, found by Newton steps over distributed sums of the counts of documents per
source and size. Rates become whole copies from large sizes to small, each size making up for the rounding before it,
so a source misses its target by about one small document.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_RE, staged

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
STEPS = 100
#: Cells (a source and a size) up to this number, of 50 bytes each, are broadcast; more are joined by shuffle.
MAX_BROADCAST_CELLS = 200_000
#: Documents up to this number (50 bytes each) are broadcast to their texts; more are joined by shuffle.
MAX_BROADCAST_ROWS = 1_500_000
#: Documents of a (source, size, slice) cell that one task ranks are about this many; larger cells have more slices.
CELL = 20_000


def capped_shares(sizes: list[float], weights: list[float], total: float, cap: float = CAP) -> list[float]:
    """``total`` shared by weight; no share passes ``cap`` times its size, the excess goes to the others by weight."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = min(total, cap * sum(sizes))
    while open_:
        weight = sum(weights[i] for i in sorted(open_))
        full = {i for i in open_ if left * weights[i] / weight >= cap * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in sorted(full):
            targets[i] = cap * sizes[i]
            left = max(0.0, left - targets[i])
        open_ -= full
    return targets


def _solve(spark: SparkSession, cells: DataFrame, sources: list[dict], cap: float) -> dict:
    """Lambda by source number: safeguarded Newton steps, all sources at once, one join with the lambdas so far and one
    aggregation a step.
    """
    targets = {s["number"]: s["target"] for s in sources}
    state = {s["number"]: {"at": 0.0, "low": -math.inf, "high": math.inf, "open": 0 < s["target"] < cap * s["size"] * (1 - 1e-12)} for s in sources}
    for _ in range(STEPS):
        now = {n: x["at"] for n, x in state.items() if x["open"]}
        if not now:
            break
        table = spark.createDataFrame(list(now.items()), "number int, lam double")
        rate = F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("z"), F.lit(50.0))))
        free = rate < cap
        words = F.col("n") * F.col("size")
        exact = "decimal(38,6)"
        sums = cells.join(F.broadcast(table), "number").groupBy("number").agg(
            F.sum((rate * words).cast(exact)).alias("f"),
            F.sum(F.when(free, rate * words * F.col("z")).otherwise(0.0).cast(exact)).alias("g"),
        )
        for r in sums.collect():
            x, target = state[r["number"]], targets[r["number"]]
            miss = float(r["f"]) - target
            if abs(miss) <= 1e-9 * target + 1e-5:
                x["open"] = False
                continue
            x["high" if miss > 0 else "low"] = x["at"]
            step = x["at"] - miss / float(r["g"]) if r["g"] else math.nan
            step = min(max(step, x["at"] - 5.0), x["at"] + 5.0)
            if not x["low"] < step < x["high"]:
                low, high = x["low"], x["high"]
                step = (low + high) / 2 if math.isfinite(low) and math.isfinite(high) else x["at"] + (-5.0 if miss > 0 else 5.0)
            if step == x["at"] or abs(step) > 1e6:
                x["open"] = False
            x["at"] = step
    return {n: round(x["at"], 12) for n, x in state.items()}


def mix(
    spark: SparkSession, docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", cell: int = CELL,
) -> DataFrame:
    """``id_col, source_col, size, source_size, target, rate, copies`` for every row of ``docs``.

    ``size`` counts words (0 for a null or empty text, which is kept with one copy at most: it weighs nothing). Sources
    are ordered by code point, null last, and take ``weights`` in turn. Null and repeated ids and texts are rows like
    others; ties are ordered by id, then text, and rows equal in both are interchangeable. A source without words
    keeps a target of 0. An empty table gives an empty result. Other columns are not read.

    Sources must be few enough to list on the driver (one row each; 100,000 at most).
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_RE)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tie"))
    rows = staged(spark, rows, "sizes")
    listed = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(100_001).collect()
    if len(listed) > 100_000:
        raise ValueError("more than 100,000 sources")
    listed = sorted(listed, key=lambda r: (r["source"] is None, r["source"] or ""))
    targets = capped_shares([float(r["size"]) for r in listed], [weights[i % len(weights)] for i in range(len(listed))], share * sum(r["size"] for r in listed), cap)
    sources = [{"number": i, "source": r["source"], "size": r["size"], "n": r["n"], "target": t} for i, (r, t) in enumerate(zip(listed, targets, strict=True))]
    table = spark.createDataFrame(
        [(s["number"], s["source"], s["size"], s["target"], s["n"] / s["size"] if s["size"] else 0.0) for s in sources],
        "number int, source string, source_size long, target double, scale double",
    )
    named = rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).drop(table["source"])
    cells = named.groupBy("number", "size", "scale").agg(F.count("*").alias("n")).withColumn("z", F.col("size") * F.col("scale"))
    cells = staged(spark, cells, "cells")
    found = _solve(spark, cells, sources, cap)
    lams = spark.createDataFrame([(s["number"], found[s["number"]], s["target"] >= cap * s["size"] * (1 - 1e-12), s["target"] <= 0) for s in sources], "number int, lam double, full boolean, none boolean")
    rate = F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("z"), F.lit(50.0))))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("full"), F.lit(cap)).when(F.col("none"), F.lit(0.0)).otherwise(rate)
    rated = cells.join(F.broadcast(lams), "number").select("number", "size", "n", rate.alias("rate"))
    schema = "number int, size long, n long, rate double, base long, extra long"
    plan = staged(spark, rated.groupBy("number").applyInPandas(_whole_copies, schema), "plan")

    # A cell's documents in slices, ranked inside each; the cell's extra copies fall on evenly spaced ranks.
    hashed = F.xxhash64("id", "tie")
    placed = named.select("id", "source", "tie", "number", "size", "source_size", "target", hashed.alias("h"))
    few = plan.count() <= MAX_BROADCAST_CELLS
    keyed = placed.join(F.broadcast(plan) if few else plan, ["number", "size"])
    keyed = keyed.withColumn("slice", F.pmod("h", F.greatest(F.lit(1), F.ceil(F.col("n") / cell)).cast("long")))
    parts = keyed.groupBy("number", "size", "slice").agg(F.count("*").alias("held"))
    before = W.partitionBy("number", "size").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)))
    parts = staged(spark, parts.where("start > 0").select("number", "size", "slice", "start"), "slices")
    few = parts.count() <= MAX_BROADCAST_CELLS
    keyed = keyed.join(F.broadcast(parts) if few else parts, ["number", "size", "slice"], "left")
    rank = F.row_number().over(W.partitionBy("number", "size", "slice").orderBy("h", "id", "tie"))
    keyed = keyed.withColumn("at", F.coalesce("start", F.lit(0)) + rank - 1)
    upto = "(cast(at + {} as decimal(19,0)) * cast(extra as decimal(19,0))) div cast(n as decimal(19,0))"
    copies = (F.col("base") + F.expr(upto.format(1)) - F.expr(upto.format(0))).cast("long")
    return keyed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate",
        copies.alias("copies"), F.col("tie").alias("text_hash"),
    )


def _whole_copies(cells: pd.DataFrame) -> pd.DataFrame:
    """One source's cells (a row for each distinct size, so their number is bounded by the longest text's words).

    From large to small, each cell takes the whole number of copies that brings the words taken so far nearest to the
    words planned; what is left over is at most half of the last size that had a choice.
    """
    cells = cells.sort_values("size", ascending=False, ignore_index=True)
    base, extra, carry = [], [], 0.0
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"], strict=True):
        low, high = n * math.floor(rate), n * math.ceil(rate)
        taken = n if size == 0 else min(high, max(low, round(n * rate + carry / size)))
        carry += size * (n * rate - taken)
        base.append(taken // n)
        extra.append(taken % n)
    cells["base"], cells["extra"] = base, extra
    return cells[["number", "size", "n", "rate", "base", "extra"]]


def mixed_rows(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` copies them, with all their columns.

    Rows that repeat id, text and source are taken together: the first of them stands for all their copies.
    """
    mixed = mix(spark, docs, id_col=id_col, text_col=text_col, **settings)
    source = settings.get("source_col", "source")
    keys = [F.col(id_col).alias("__id"), F.col(source).cast("string").alias("__source"), F.col("text_hash").alias("__tie")]
    taken = mixed.groupBy(*keys).agg(F.sum("copies").alias("__copies"), F.count("*").alias("__n"))
    taken = staged(spark, taken, "taken")
    small = F.broadcast(taken) if taken.count() <= MAX_BROADCAST_ROWS else taken
    tie = F.coalesce(F.xxhash64(text_col), F.lit(0))
    same = docs[id_col].eqNullSafe(small["__id"]) & docs[source].cast("string").eqNullSafe(small["__source"]) & (tie == small["__tie"])
    joined = docs.join(small, same)
    if not taken.where("__n > 1").isEmpty():
        joined = joined.where("__n = 1").unionAll(joined.where("__n > 1").dropDuplicates(["__id", "__source", "__tie"]))
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))
    return joined.where("__copies > 0").withColumn("__copy", copies).select(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; odd rows, ties and empty tables: see ``mix``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix(spark, docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
