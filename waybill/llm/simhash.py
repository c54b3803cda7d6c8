"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most ``max_bits`` bits, cut into ``max_bits // 2 + 1`` segments, have a segment
that differs in at most one bit. So every segment is indexed as it is and with each of its bits replaced by a
wildcard; links come from equality on those keys and are verified on the whole fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FEW_LINKS, components, flat_components, staged, written_by_workers

#: Members of a bucket that one task compares; larger buckets are cut into tiles of two blocks.
BUCKET = 4096
#: Hot keys up to this number are broadcast (16 bytes each); more are joined by shuffle.
MAX_BROADCAST_KEYS = 100_000
#: Documents that stay, up to this number (40 bytes each), are broadcast; more are joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def sign_bits(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have set; 0 without hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        block = hashes[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash over XXH64 of the word shingles of a text; 0 where it has no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        grams = zip(*(words[i:] for i in range(shingle)), strict=False)
        hashes = np.fromiter((digest(join(g), seed) for g in grams), np.uint64, len(words) - shingle + 1)
    return sign_bits(hashes)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (``id_col`` unless given) and ``_fp`` (the fingerprint's bits as a signed long) of every row."""
    keep = keep or [id_col]
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "_text"), T.StructField("_fp", T.LongType())])

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(keep))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(prints.view(np.int64))], schema.names)

    return rows.mapInArrow(run, schema)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(start, width) of the segments of which one differs in at most one bit; at least two, as keys have 32 bits."""
    n = max(2, max_bits // 2 + 1)
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _keys(max_bits: int, wildcards: bool) -> list:
    """Column expressions of the index keys of ``fp``: bits 32 up name the slot, bits below hold the segment."""
    out = []
    for n, (start, width) in enumerate(segments(max_bits)):
        value = F.shiftrightunsigned(F.col("fp"), start).bitwiseAND(F.lit((1 << width) - 1))
        out.append(value.bitwiseOR(F.lit((64 + n) << 32)))
        if wildcards:
            for bit in range(width):
                kept = ((1 << width) - 1) ^ (1 << bit)
                out.append(value.bitwiseAND(F.lit(kept)).bitwiseOR(F.lit((start + bit) << 32)))
    return out


def _bucket_links(max_bits: int):
    """Stream of rows sorted by bucket -> star links inside each batch of whole buckets."""

    def pairs_of(bucket: np.ndarray, slot: np.ndarray, fp: np.ndarray):
        """Index pairs of one batch that share a bucket and differ in at most max_bits bits.

        In a wildcard's bucket only pairs that differ in that bit count: others meet in the segment's own bucket.
        """

        def verified(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            x = fp[i] ^ fp[j]
            wild = slot[i] < 64
            apart = (x >> np.where(wild, slot[i], 0).astype(np.uint64)) & np.uint64(1) == 1
            return (np.bitwise_count(x) <= max_bits) & (apart | ~wild)

        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(bucket)])
        small = np.repeat(sizes <= 64, sizes)
        left = np.repeat(starts + sizes, sizes) - np.arange(len(bucket))  # rows to the bucket's end
        for d in range(1, 64):
            i = np.flatnonzero(small & (left > d))
            if not len(i):
                break
            ok = verified(i, i + d)
            yield i[ok], i[ok] + d
        for start, size in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
            for a in range(start, start + size, 256):
                for b in range(a, start + size, 4096):
                    i, j = np.arange(a, min(a + 256, start + size)), np.arange(b, min(b + 4096, start + size))
                    i, j = np.repeat(i, len(j)), np.tile(j, len(i))
                    ok = (i < j) & verified(i, j)
                    yield i[ok], j[ok]

    def solve(bucket, slot, fp):
        values, at = np.unique(fp, return_inverse=True)
        label = np.arange(len(values))
        for i, j in pairs_of(bucket, slot, fp):
            u, v = label[at[i]], label[at[j]]
            apart = u != v
            if apart.any():
                label = flat_components(u[apart], v[apart], len(values))[label]
        linked = np.flatnonzero(label != np.arange(len(values)))
        links = [values[linked].view(np.int64), values[label[linked]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in links], ["a", "b"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            key, t1, t2, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if not len(key):
                continue
            held.append((key, t1, t2, fp))
            key, t1, t2, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            new = (key[1:] != key[:-1]) | (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])
            bucket = np.r_[0, np.cumsum(new)]
            end = np.searchsorted(bucket, bucket[-1])
            held = [(key[end:], t1[end:], t2[end:], fp[end:])]
            if end:
                yield solve(bucket[:end], key[:end] >> 32, fp[:end].view(np.uint64))
        if held:
            key, _, _, fp = held[0]
            yield solve(np.zeros(len(key), np.int64), key >> 32, fp.view(np.uint64))

    return run


def links(spark: SparkSession, prints: DataFrame, max_bits: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` whose connected components are those of all pairs of fingerprints within ``max_bits`` bits.

    ``prints`` has distinct longs ``fp``. Each task returns a spanning star for what its buckets connect, so links
    number at most as many as index rows and never all pairs of a group. Where a segment's value has more than
    ``bucket`` members, its buckets are cut into blocks, and every two blocks meet in a task of their own.
    """
    rows = prints.select("fp", F.explode(F.array(*_keys(max_bits, True))).alias("key"))
    plain = prints.select(F.explode(F.array(*_keys(max_bits, False))).alias("key"))
    zero = F.lit(0)
    if plain.groupBy("key").count().where(F.col("count") > bucket).isEmpty():
        tiles = rows.select("key", zero.alias("t1"), zero.alias("t2"), "fp")
    else:
        hot = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
        hot, _ = written_by_workers(spark, hot, "hot")
        few = hot.count() <= MAX_BROADCAST_KEYS
        blocks = F.ceil(F.coalesce("n", F.lit(1)) / bucket).cast("int")
        cut = rows.join(F.broadcast(hot) if few else hot, "key", "left").withColumn("blocks", blocks)
        cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
        tiles = cut.select("key", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"), "fp")
    parts = tiles.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2")
    return parts.mapInArrow(_bucket_links(max_bits), "a long, b long").distinct()


def _classes(spark: SparkSession, prints: DataFrame, id_col: str, link, few: int = 0) -> DataFrame:
    """``fp, _rep`` (smallest id of the fingerprint, null last) and ``_root`` (its class) of every fingerprint of ``prints``.

    Other columns of ``prints`` come along: ``_tid`` is that of the smallest id, others depend on the fingerprint alone.
    """
    rest = [c for c in prints.columns if c not in (id_col, "_fp", "_tid")]
    tid = ["_tid"] if "_tid" in prints.columns else []
    best = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("_rep"), *tid)).alias("best")
    nodes = prints.groupBy(F.col("_fp").alias("fp")).agg(best, *(F.first(c).alias(c) for c in rest))
    nodes, _ = written_by_workers(spark, nodes.select("fp", *(f"best.{c}" for c in ("_rep", *tid)), *rest), "nodes")
    found = components(spark, link(nodes), few)
    placed = nodes.join(found, nodes["fp"] == found["node"], "left")
    return placed.select("fp", "_rep", *tid, F.coalesce("root", "fp").alias("_root"))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
    max_bits: int = 4, bucket: int = BUCKET,
) -> DataFrame:
    """``id_col, fp, component_id`` for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other; half of the shingles is not enough for a bit.
    Rows that repeat an id or a text stay, each with its class; ``component_id`` is the smallest non-null id of the class (null where all are null). An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    prints = staged(spark, fingerprints(docs, id_col, text_col, shingle), "prints")
    placed = _classes(spark, prints, id_col, lambda nodes: links(spark, nodes.select("fp"), max_bits, bucket))
    classes = placed.groupBy("_root").agg(F.min("_rep").alias("component_id"))
    placed = placed.join(classes, "_root").select("fp", "component_id")
    return prints.withColumnRenamed("_fp", "fp").join(placed, "fp").select(id_col, "fp", "component_id")


def keep_one(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
    max_bits: int = 4, bucket: int = BUCKET,
) -> DataFrame:
    """The rows of ``docs`` that stay when each class of near-duplicates keeps the one with the smallest id.

    A null id comes last; of rows that repeat the winning id with the same fingerprint one stays.
    """

    def name(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
        return fingerprints(rows, id_col, text_col, shingle, keep)

    return keep_winners(spark, docs, id_col, text_col, name, lambda nodes: links(spark, nodes.select("fp"), max_bits, bucket))


def keep_winners(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, name, link) -> DataFrame:
    """``keep_one`` by any names: ``name(rows, keep)`` adds ``_fp`` to rows, ``link(nodes)`` gives links of names.

    Rows are named once; the ones that stay are found again by their ids and the digests of their texts.
    """
    tid = F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")))
    prints = staged(spark, name(docs.withColumn("_tid", tid), [id_col, "_tid"]), "prints")
    placed = _classes(spark, prints, id_col, link, FEW_LINKS)
    order = F.struct(F.col("_rep").isNull().alias("none"), F.col("_rep").alias("id"), F.col("fp"), F.col("_tid").alias("tid"))
    winners = placed.groupBy("_root").agg(F.min(order).alias("w")).select(F.col("w.id").alias("_id"), F.col("w.tid").alias("_wtid"))
    winners, _ = written_by_workers(spark, winners, "winners")
    small = F.broadcast(winners) if winners.count() <= MAX_BROADCAST_ROWS else winners
    rows = docs.withColumn("_tid", tid)
    kept = rows.join(small, (rows["_tid"] == small["_wtid"]) & rows[id_col].eqNullSafe(small["_id"]), "left_semi")
    repeated = prints.join(small, (prints["_tid"] == small["_wtid"]) & prints[id_col].eqNullSafe(small["_id"]), "left_semi")
    if not repeated.groupBy(id_col, "_tid").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, "_tid"])
    return kept.select(*docs.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document; odd rows, ties and empty tables: see ``near_duplicates``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(spark, docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
