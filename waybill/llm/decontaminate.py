"""Benchmark decontamination by winnowing.

Every text keeps, of each window of consecutive k-gram hashes, the smallest. A span of ``words`` words that a document
and an item share has the same window in both, so it leaves the same fingerprint in both. Fingerprints of documents are
joined with those of the items; texts with common ones extend each hit to the windows of words around it, and those
windows are joined, word for word, with the windows of the items.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

#: Words of a window, and of a winnowed k-gram.
WORDS, GRAM = 10, 5
#: Fingerprints of the benchmark up to this number (16 bytes each) are broadcast; more are joined by a salted shuffle.
MAX_BROADCAST_KEYS = 1_000_000
SALTS = 16
#: Texts with hits are broadcast up to this many rows and windows (some 100 bytes each); more are joined by shuffle.
MAX_BROADCAST_ROWS = 300_000
#: Bytes that words consist of (digits, letters and all beyond ASCII); letters become lower case.
_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEEP).split()


class Numbers(dict):
    """A 64-bit number for every word met, made from the word's bytes alone."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < self.LIMIT:
            self[word] = value
        return value


def gram_hashes(numbers: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word numbers."""
    n = len(numbers) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ numbers[i : i + n]) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


def winnow(numbers: np.ndarray, words: int = WORDS, k: int = GRAM) -> np.ndarray:
    """Places of the k-grams that are the smallest (first of equals) of some window of ``words - k + 1`` k-grams."""
    hashes = gram_hashes(numbers, k)
    size = words - k + 1
    if len(hashes) < size:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, size)
    return np.unique(np.arange(len(views)) + views.argmin(axis=1))


def keys_of(numbers: np.ndarray, words: int, k: int, shorter: list[int]) -> np.ndarray:
    """Distinct fingerprints of a text, and the hashes of all its n-grams for each n of ``shorter``; n is part of a key."""
    parts = [gram_hashes(numbers, k)[winnow(numbers, words, k)] * np.uint64(words), *(gram_hashes(numbers, n) * np.uint64(2 * n + 1) for n in shorter)]
    return np.unique(np.concatenate(parts))


def window_starts(numbers: np.ndarray, found: np.ndarray, words: int, k: int, shorter: list[int]) -> list[tuple[int, int]]:
    """(start, words) of the windows that a text's keys among ``found`` can be part of."""
    places = winnow(numbers, words, k)
    hits = places[np.isin(gram_hashes(numbers, k)[places] * np.uint64(words), found)]
    starts = {s for p in hits.tolist() for s in range(max(0, p + k - words), min(p, len(numbers) - words) + 1)}
    out = [(s, words) for s in sorted(starts)]
    for n in shorter:
        out += [(int(s), n) for s in np.flatnonzero(np.isin(gram_hashes(numbers, n) * np.uint64(2 * n + 1), found))]
    return out


def _item_windows(items: DataFrame, words: int) -> DataFrame:
    """``item, n, window`` of every window of every item: ``words`` words, or all of an item of fewer."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                out = []
                for name, text in zip(*(c.slice(a, 64).to_pylist() for c in batch.columns), strict=True):
                    item = words_of(text)
                    n = min(words, len(item))
                    out += [(name, n, b" ".join(item[i : i + n])) for i in range(len(item) - n + 1) if n]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.binary()), strict=True)], ["item", "n", "window"])

    return items.mapInArrow(run, "item string, n int, window binary").distinct()


def find_contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", words: int = WORDS, k: int = GRAM, keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (``id_col`` unless given), ``n_words, spans, items`` for every row of ``docs``.

    ``spans`` lists the maximal runs of hit words as (start, end) word numbers; ``items`` the sorted item ids. Null
    and empty texts have no words; items without words or without an id never occur; items that repeat an id are
    taken together. Rows that repeat an id or a text are answered each; texts are searched once. Empty tables of either
    kind give rows without hits, or no rows. Columns beside ``keep`` are not read.
    """
    keep = keep or [id_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*[F.col(c) for c in keep], text.alias("__text")).withColumn("__tid", F.unhex(F.md5(F.col("__text").cast("binary"))))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item is not null and text is not null")
    windows = staged(spark, _item_windows(items, words), "windows")
    shorter = sorted(r["n"] for r in windows.where(F.col("n") < words).select("n").distinct().collect())  # fewer than ``words``

    def item_keys(batches):
        numbers = Numbers()
        for batch in batches:
            out = []
            for text in batch.column(0):
                item = words_of(text.as_py())
                at = np.array([numbers[w] for w in item], np.uint64)
                out.append(keys_of(at, words, k, [len(item)] if 0 < len(item) < words else []))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out or [np.zeros(0, np.uint64)]).view(np.int64))], ["key"])

    def text_keys(batches):
        numbers = Numbers()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                out = []
                for text in batch.column(1).slice(a, 256):
                    found = words_of(text.as_py())
                    out.append(keys_of(np.fromiter(map(numbers.__getitem__, found), np.uint64, len(found)), words, k, shorter))
                cuts = np.r_[0, np.cumsum([len(x) for x in out])].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 256), pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(out).view(np.int64)))], ["tid", "keys"])

    known = staged(spark, items.select("text").mapInArrow(item_keys, "key long").distinct(), "keys")
    texts = rows.select(F.col("__tid").alias("tid"), F.col("__text").alias("text"))
    own = texts.mapInArrow(text_keys, "tid binary, keys array<long>").select("tid", F.explode("keys").alias("key"))
    if known.count() <= MAX_BROADCAST_KEYS:
        common = own.join(F.broadcast(known), "key", "left_semi")
    else:  # a key that many texts have is dealt out to SALTS tasks
        copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        common = own.withColumn("salt", F.pmod(F.xxhash64("tid"), F.lit(SALTS)).cast("int")).join(copies, ["key", "salt"], "left_semi")
    hits = staged(spark, common.groupBy("tid").agg(F.collect_set("key").alias("keys")), "hits")

    def extend(batches):
        numbers = Numbers()
        for batch in batches:
            out = []
            for tid, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = words_of(text)
                at = np.fromiter(map(numbers.__getitem__, own), np.uint64, len(own))
                out += [(tid, s, n, b" ".join(own[s : s + n])) for s, n in window_starts(at, np.array(found, np.int64).view(np.uint64), words, k, shorter)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["tid", "start", "n", "window"])

    few = hits.count() <= MAX_BROADCAST_ROWS
    once = texts.join(F.broadcast(hits.select("tid")) if few else hits.select("tid"), "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"))
    extended = once.join(hits, "tid").select("tid", "text", "keys").mapInArrow(extend, "tid binary, start long, n int, window binary")
    matched = extended.join(windows, ["window", "n"]).groupBy("tid").agg(F.collect_set(F.struct("start", "n")).alias("runs"), F.sort_array(F.collect_set("item")).alias("items"))
    matched = staged(spark, matched.mapInArrow(_spans, f"tid binary, spans {SPANS}, items array<string>"), "matched")
    size = matched.agg(F.count("*") + F.sum(F.size("spans") + F.size("items"))).first()[0] or 0
    joined = rows.join(F.broadcast(matched) if size <= MAX_BROADCAST_ROWS else matched, rows["__tid"] == matched["tid"], "left")
    none = lambda c, kind: F.coalesce(c, F.expr(f"cast(array() as {kind})")).alias(c)
    joined = joined.select(*keep, F.col("__text").alias("n_words"), none("spans", SPANS), none("items", "array<string>"))
    at = len(keep)

    def count(batches):
        for batch in batches:
            n = pa.array([len(words_of(t.as_py())) for t in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], n, *batch.columns[at + 1 :]], batch.schema.names)

    fields = [T.StructField("n_words", T.LongType()) if i == at else f for i, f in enumerate(joined.schema.fields)]
    return joined.mapInArrow(count, T.StructType(fields))


SPANS = "array<struct<start:bigint,end:bigint>>"


def _spans(batches):
    """(tid, windows, items) -> (tid, the maximal runs of words that windows cover, items)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for runs in batch.column(1).to_pylist():
            spans: list[dict] = []
            for r in sorted(runs, key=lambda r: r["start"]):
                end = r["start"] + r["n"]
                if spans and r["start"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], end)
                else:
                    spans.append({"start": r["start"], "end": end})
            out.append(spans)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind), batch.column(2)], ["tid", "spans", "items"])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and occurring items of every document; odd rows and empty tables: see ``find_contamination``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_contamination(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), bw AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
  WHERE text IS NOT NULL AND item_id IS NOT NULL
), bi AS (
  SELECT item, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM bw WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM bi
), ks AS (
  SELECT DISTINCT k FROM windows
), di AS (
  SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM dw, ks WHERE len(w) >= k
), hits AS (
  SELECT d.r, d.i, d.k, item FROM di d JOIN windows b ON b.k = d.k AND b.g = array_to_string(list_slice(d.w, d.i, d.i + d.k - 1), ' ')
), covered AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
