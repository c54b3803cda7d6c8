"""Near copies by word shingles: all pairs of texts whose sets of shingles reach a Jaccard similarity.

Most are found by SimHash: fingerprints of the sets, linked by deletion-variant signatures, and verified on the whole
sets. Few bits cannot reach every pair of that similarity, so prefix filtering adds the rest. It does not compare single
shingles, of which more and more are in several texts by chance as a corpus grows, but parts: the shingles of a set that
fall into the same one of as many ranges of values as its size calls for. A shingle that one of two sets lacks spoils one
part, so sets that are similar enough have equal parts, and under one order of all parts share one among the first of each.
The order puts parts last whose shingles a sample all shows to be common, and parts of many shingles first, so that hardly
any sets but near copies meet in one; any order gives the same pairs. Every candidate is verified on the whole sets, so no
pair is lost or made up. Sets of one class need not meet again: before all others do, those that share a part meet centres
of it in rounds, so that a large group of near copies is one class by then and not all its pairs.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import FEW_LINKS, components, give_back, remove, trimmed
from .common import written_by_workers as written

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
#: Texts whose shingles are counted to order all shingles; only speed depends on it.
SAMPLE = 50_000
#: Numbers of 64 bits in a set's parity marks: two sets differ in as many shingles at least as their marks in bits.
MARKS = 4
#: Shingles that come last are in so many sampled texts at least, and this number (16 bytes each) at most is broadcast.
COMMON, MAX_COMMON = 3, 500_000
#: Sets of under FIRST shingles have each shingle as a part; up to SPREAD times as many shingles have FIRST_BITS bits of ranges, up to
#: SPREAD times as many as these two bits more, and so on: 0.8 to 3.2 shingles a range, so that more parts than can be spoilt hold any.
FIRST, SPREAD, FIRST_BITS = 13, 4, 4
#: Names that a task remembers to send the prefix of a repeated set once.
REMEMBERED = 100_000
#: Rounds before all sets meet, at most, while there could be more pairs a row than the second number; a round draws about the third of
#: a part's sets as centres. Only speed depends on them.
ROUNDS, PAIRS_A_ROW, CENTRES = 3, 8, 16


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 values of the word shingles of a text; shorter texts are one shingle, no words give none."""
    words = (text or "").encode().lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < size:
        return np.array([digest(join(words), 42)] if words else [], np.uint64)
    return np.unique(np.fromiter((digest(join(g), 42) for g in zip(*(words[i:] for i in range(size)), strict=False)), np.uint64))


def _name(found: np.ndarray) -> int:
    """The name of a set of shingles, 64 bits; texts with equal sets share it."""
    return xxhash.xxh64_intdigest(found.astype("<u8").tobytes(), 42)


def _marks(found: np.ndarray) -> list[int]:
    """Bits that an odd number of a set's shingles fall on, as MARKS numbers."""
    odd = np.bincount((found % np.uint64(64 * MARKS)).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8").tolist()


def set_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (``id_col`` unless given), ``_fp``, the name of the row's set of shingles, its SimHash ``_sim`` and its marks."""
    keep = keep or [id_col]
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("_text"))
    made = ["_fp", "_sim", *(f"_m{i}" for i in range(MARKS))]
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "_text"), *(T.StructField(c, T.LongType()) for c in made)])

    def run(batches):
        for batch in batches:
            found = []
            for t in batch.column(len(keep)):
                own = shingles(t.as_py(), size)
                found.append((_name(own), simhash.sign_bits(own), *_marks(own)))
            all_of = np.array(found, np.uint64).reshape(-1, len(made)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(c) for c in all_of.T.copy())], schema.names)

    return rows.mapInArrow(trimmed(run), schema)


def _lists(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.view(np.int64) for v in values], pa.list_(pa.int64()))


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``fp, held`` (the shingles) of every row of ``texts`` (one text column)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = [shingles(t.as_py(), size) for t in batch.column(0)[at : at + 64]]
                names = np.array([_name(f) for f in found], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), _lists(found)], ["fp", "held"])

    return texts.mapInArrow(trimmed(run), "fp long, held array<long>")


def _levels(n: int, threshold: Fraction) -> list[tuple[int, int]]:
    """(bits of the ranges, parts that can be spoilt at most) for a set of n shingles; 0 bits: each shingle is a part.

    Two sets meet at the level of the larger one, so a set is at those of all sizes from its own to the largest similar.
    """
    part, whole = threshold.numerator, threshold.denominator
    reach, out, end, bits = n * whole // part, [], FIRST, 0
    while True:
        if n < end:
            out.append((bits, (n + min(reach, end - 1)) * (whole - part) // (whole + part) if bits else 0))
        if reach < end:
            return out
        bits, end = bits + 2 if bits else FIRST_BITS, end * SPREAD


def _parts(found: np.ndarray, rank: np.ndarray, threshold: Fraction) -> np.ndarray:
    """The first parts of a set under the order, as many as can decide, at each of its levels, as numbers of 64 bits.

    ``rank`` is how common each shingle is. Where all parts of a level could be spoilt, all are given, and single shingles
    too: there it meets sets of the same kind; sets of more parts have one that is left in any case.
    """
    n, out, alone = len(found), [], False
    single = np.lexsort((found, rank))[: n - -(-n * threshold.numerator // threshold.denominator) + 1]
    for bits, spoilt in _levels(n, threshold):
        if bits:
            ranges = found >> np.uint64(64 - bits)
            starts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
            name = np.add.reduceat(found, starts) + np.uint64(bits * 0x9E3779B97F4A7C15 % 2**64)
            order = np.lexsort((name, -np.diff(np.r_[starts, n]), np.minimum.reduceat(rank, starts)))
            out.append(name[order[: spoilt + 1]])
        if not alone and (not bits or len(name) <= spoilt):
            out.append(found[single])
            alone = True
    return np.concatenate(out)


def _prefixes(texts: DataFrame, common, size: int, threshold: Fraction) -> DataFrame:
    """``token, fp, n``: the first parts of every text's set, and the set's name and number of shingles.

    A task leaves out most sets that it has seen; other repeats stay.
    """

    def run(batches):
        last, times = common.value
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for text in batch.column(0)[at : at + 256]:
                    found = shingles(text.as_py(), size)
                    n = len(found)
                    if not n or (own := _name(found)) in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(own)
                    rank = np.zeros(n, np.int64)
                    if len(last):
                        spot = np.minimum(np.searchsorted(last, found), len(last) - 1)
                        rank = np.where(last[spot] == found, times[spot], 0)
                    first = _parts(found, rank, threshold)
                    m = len(first)
                    out.append((first.view(np.int64), np.full(m, own, np.uint64).view(np.int64), np.full(m, n, np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["token", "fp", "n"])

    return texts.mapInArrow(trimmed(run), "token long, fp long, n int")


def _common(spark: SparkSession, texts: DataFrame, size: int):
    """Broadcast (sorted shingles that come last, times each is in the sampled ``texts``).

    Most shingles are in one text, so they are dealt out before they are counted: a table of a task's own would only grow.
    """
    tokens = _sets(texts, size).select(F.explode("held").alias("token")).repartition("token")
    tokens = tokens.groupBy("token").count().where(F.col("count") >= COMMON)
    found = tokens.orderBy(F.desc("count"), "token").limit(MAX_COMMON).toArrow()
    token = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(token)
    out = spark.sparkContext.broadcast((token[order], found.column(1).to_numpy()[order]))
    del found, token, order
    give_back()  # also what stages before this one have left on the driver
    return out


def links(spark: SparkSession, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, size: int, threshold: Fraction) -> DataFrame:
    """Links ``a, b`` whose connected components are those of all pairs of sets with the similarity ``threshold``.

    ``nodes`` has the distinct names ``fp`` of the sets of ``docs``, an id ``_rep``, the SimHash ``_sim`` and the parity marks of each.
    First each set meets the sets that SimHash links it with and a few centres of its parts; then all sets meet that
    share a part, are not yet connected, and whose parity marks differ in few enough bits.
    """
    part, whole = threshold.numerator, threshold.denominator
    total = nodes.count()

    def texts_of(names: DataFrame) -> DataFrame:
        few = names.count() <= simhash.MAX_BROADCAST_ROWS
        ids = names.select(F.col("_rep").alias("_id"))
        return docs.join(F.broadcast(ids) if few else ids, docs[id_col].eqNullSafe(ids["_id"]), "left_semi").select(F.col(text_col).cast("string"))

    drawn = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < F.lit(1_000_000 * SAMPLE / max(total, 1)))
    common = _common(spark, texts_of(drawn), size)
    centre = F.struct(F.xxhash64("fp", F.pmod("token", F.lit(4))).alias("_"), F.col("fp"), F.col("n"))
    mates = Window.partitionBy("token")
    index = _prefixes(docs.select(F.col(text_col).cast("string")), common, size, threshold)
    index = index.withColumns({"low": F.min("fp").over(mates), "high": F.max("fp").over(mates), "c": F.min(centre).over(mates)})
    index, index_at = written(spark, index.where("low < high").select("token", "fp", "n", "c").distinct(), "shared")
    marks = [f"_m{i}" for i in range(MARKS)]

    def may_reach(rows: DataFrame) -> DataFrame:
        """Rows whose two sets may be similar enough by their sizes and marks."""
        n, m = F.col("n"), F.col("n2")
        differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}2"))) for c in marks[1:]), F.bit_count(F.col(marks[0]).bitwiseXOR(F.col(f"{marks[0]}2"))))
        return rows.where(F.least(n, m) * F.lit(whole) >= F.greatest(n, m) * F.lit(part)).where(differ * F.lit(part + whole) <= (n + m) * F.lit(whole - part))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs, pairs_at = written(spark, pairs.distinct(), f"{name}-pairs")
        used = pairs.select(F.col("a").alias("fp")).unionAll(pairs.select(F.col("b").alias("fp"))).distinct()
        used, used_at = written(spark, nodes.select("fp", "_rep").join(used, "fp", "left_semi"), f"{name}-used")
        held = _sets(texts_of(used), size).join(used.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
        held, held_at = written(spark, held, f"{name}-sets")
        left, right = held.select(F.col("fp").alias("a"), F.col("held").alias("x")), held.select(F.col("fp").alias("b"), F.col("held").alias("y"))
        both = pairs.join(left, "a").join(right, "b")
        near = F.size(F.array_intersect("x", "y")) * F.lit(part + whole) >= (F.size("x") + F.size("y")) * F.lit(part)
        out, _ = written(spark, both.where(near).select("a", "b"), f"{name}-links")
        for path in (pairs_at, used_at, held_at):
            remove(spark, path)
        return out

    def paired(rows: DataFrame, x: str = "fp", y: str = "fp2") -> DataFrame:
        return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    by_sim, _ = written(spark, nodes.groupBy("_sim").agg(F.min("fp").alias("first")), "sims")
    near = simhash.links(spark, by_sim.select(F.col("_sim").alias("fp")))
    ends = by_sim.toDF("_sim", "fp2")
    alike = near.join(by_sim, near["a"] == by_sim["_sim"]).select("b", F.col("first").alias("fp")).join(ends, F.col("b") == ends["_sim"]).select("fp", "fp2")
    alike = alike.unionAll(nodes.join(by_sim, "_sim").where(F.col("fp") != F.col("first")).select("fp", F.col("first").alias("fp2")))
    marked = nodes.select("fp", *marks)
    stars = index.where(F.col("fp") != F.col("c.fp")).select("fp", "n", F.col("c.fp").alias("fp2"), F.col("c.n").alias("n2")).distinct()
    stars = may_reach(stars.join(marked, "fp").join(marked.toDF("fp2", *(f"{c}2" for c in marks)), "fp2"))
    made = verified(paired(stars.select("fp", "fp2").unionAll(alike)), "star")

    def apart() -> tuple[DataFrame, str]:
        """The rows of ``index`` whose part is in several classes, with class and marks."""
        found = components(spark, made, FEW_LINKS)
        placed = index.join(found, index["fp"] == found["node"], "left").select("token", "fp", "n", F.coalesce("root", "fp").alias("root"))
        placed, placed_at = written(spark, placed, "placed")
        classes = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
        rows = placed.join(classes, "token", "left_semi").join(marked, "fp")
        rows = written(spark, rows.select("token", "fp", "n", "root", *marks), "apart")
        remove(spark, placed_at)
        return rows

    x, apart_at = apart()
    twice = ["fp", "n", "root", *marks]
    for turn in range(ROUNDS):
        sizes = x.groupBy("token").count()
        rows, pairs = sizes.agg(F.sum("count"), F.sum(F.expr("count * (count - 1.0) / 2"))).first()
        if not rows or pairs <= PAIRS_A_ROW * rows:
            break
        drawn = x.join(sizes, "token").where(F.pmod(F.xxhash64("fp", "token", F.lit(turn)), F.col("count")) < CENTRES)
        met = x.join(drawn.select("token", *(F.col(c).alias(f"{c}2") for c in twice)), "token")
        more = verified(paired(may_reach(met.where("root <> root2"))), "round")
        if more.isEmpty():
            break
        made = made.unionAll(more)
        remove(spark, apart_at)
        x, apart_at = apart()
    remove(spark, index_at)
    y = x.toDF("token", *(f"{c}2" for c in twice))
    rest = may_reach(x.join(y, "token").where("fp < fp2 AND root <> root2"))
    made = made.unionAll(verified(paired(rest), "rest"))
    remove(spark, apart_at)
    return made


def keep_one(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that stay when each class of near copies keeps the one with the smallest id.

    Classes are connected by pairs of the similarity ``threshold``. Null and empty texts and texts without words are
    copies of each other; texts under ``size`` words only of texts with the same words. A null id comes last; of rows
    that repeat the winning id with the same set of shingles one stays. An empty table gives an empty result.
    """

    def name(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
        return set_names(rows, id_col, text_col, size, keep)

    def link(nodes: DataFrame) -> DataFrame:
        return links(spark, docs, nodes, id_col, text_col, size, threshold)

    return simhash.keep_winners(spark, docs, id_col, text_col, name, link)
