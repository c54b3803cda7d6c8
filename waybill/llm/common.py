"""Helpers that several operators share: the shared folder, written tables, words, components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of rows that a Python worker holds for one row group of a working table.
GROUP_BYTES = 8 << 20
#: Links, up to this number (16 bytes each), that one task of ``components`` may take where a caller allows it.
FEW_LINKS = 500_000
#: Words of the counting contracts: runs of anything but space and \t..\r, as bytes.split() cuts them.
WORD_RE = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent and all runs in one process (local tests) is a folder of our own made and set; on a
    cluster executors would write to disks that others cannot see, so that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="waybill-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it goes when this process ends."""
    path = f"{shared_dir(spark).rstrip('/')}/waybill-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(``df`` as read back from the shared folder, its path): lineage ends at files any executor can read."""
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return written(spark, df, name)[0]


def written_by_workers(spark: SparkSession, df: DataFrame, name: str, made: tuple | None = None) -> tuple[DataFrame, str]:
    """``written`` for working tables of longs, integers, doubles, booleans, binaries and structs of these, by the Python workers.

    Without its native library, Hadoop's local file system starts a process for every file and folder that a task makes;
    until that runs, it shares the executor's memory and doubles what is measured of it. Workers start none. ``made`` is
    (function of Arrow batches, schema) to apply on the way, as mapInArrow would. A task writes under a hidden name of its
    attempt, and the driver gives those that count their names. Other folders and types are written by Spark; lists are
    taken from ``made`` only, whose batches are as small as it makes them.
    """
    schema = T.StructType.fromDDL(made[1]) if made else df.schema
    path = shared_path(spark, name)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() != "file" or not _flat(schema, bool(made)):
        (df.mapInArrow(*made) if made else df).write.parquet(path)
        return spark.read.schema(schema).parquet(path), path
    _, root = file_system(path)
    os.makedirs(root, exist_ok=True)
    names = df.mapInArrow(trimmed(_parquet_writer(root, to_arrow_schema(schema), made[0] if made else None)), "name string").collect()
    for n, row in enumerate(names):
        os.rename(f"{root}/{row.name}", f"{root}/part-{n:05d}.parquet")
    return spark.read.schema(schema).parquet(path), path


def _flat(kind: T.DataType, lists: bool) -> bool:
    if isinstance(kind, T.StructType):
        return all(_flat(f.dataType, lists) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return lists and _flat(kind.elementType, lists)
    return isinstance(kind, (T.LongType, T.IntegerType, T.BooleanType, T.DoubleType, T.BinaryType))


def _parquet_writer(root: str, schema: pa.Schema, made):
    """Batches (through ``made``, if any) -> the name of a file with all their rows; none for no rows."""

    def run(batches):
        import pyarrow.parquet as pq

        name, out, held, size = f"_attempt-{uuid.uuid4().hex}.parquet", None, [], 0
        try:
            for batch in with_end(made(batches) if made else batches):
                if batch is not None and batch.num_rows:
                    held.append(batch)
                    size += batch.nbytes
                if held and (batch is None or size >= GROUP_BYTES):
                    out = out or pq.ParquetWriter(f"{root}/{name}", schema, use_dictionary=False, compression="zstd", compression_level=1)
                    out.write_table(pa.Table.from_batches(held).cast(schema))
                    held, size = [], 0
        finally:
            if out:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([name] if out else [], pa.string())], ["name"])

    return run


def trimmed(run):
    """``run`` over batches; after the last one the worker, which later tasks use again, gives freed memory back."""

    def and_trim(batches):
        yield from run(batches)
        give_back()

    return and_trim


def give_back() -> None:
    """This process gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def with_end(batches):
    """The batches, then None."""
    yield from batches
    yield None


def carried(docs: DataFrame, own: tuple[str, ...]):
    """(``docs`` with every column but ``own`` under a name no operator uses, a function that gives the names back)."""
    names = {c: c if c in own else f"__carried_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), lambda df: df.select(*(F.col(f"`{n}`").alias(c) for c, n in names.items()))


def file_system(url: str):
    """(pyarrow file system, path) of a folder named by URL or by an absolute path."""
    from pyarrow import fs

    url = re.sub(r"^file:/+", "/", url)
    return fs.FileSystem.from_uri(url)


def flat_components(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links (u, v)."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while not np.array_equal(up := label[label], label):
            label = up
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
    return label


def _solved(batches):
    """Batches of links ``a, b``, all of them -> ``node, root`` of every node."""
    ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if ends:
        a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
        nodes, at = np.unique(np.r_[a, b], return_inverse=True)
        label = flat_components(at[: len(a)], at[len(a) :], len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "root"])


def components(spark: SparkSession, edges: DataFrame, few: int = 0) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` has long columns ``a`` and ``b``. Returns ``node, root`` for each node with a link, ``root``
    being the smallest node reachable. Every round is cut by a written table; a node's neighbours meet only
    in partial minimum aggregates and in joins that adaptive execution may split, so a hub never gathers
    in one task. ``few`` links at most, counted, are one task's work instead: each round is some jobs.
    """

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionAll(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(low, "u")
        out = joined.where("v > u") if large else joined
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    now, path = written_by_workers(spark, edges.select("a", "b").where("a <> b"), "links")
    if few and now.count() <= few:
        found, _ = written_by_workers(spark, now.coalesce(1), "classes", (_solved, "node long, root long"))
        remove(spark, path)
        return found
    before = None
    while (after := state(now))[0] and after != before:
        before, old = after, path
        now, path = written_by_workers(spark, stars(stars(now, True), False), "links")
        remove(spark, old)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
