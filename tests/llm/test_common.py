import glob
import os

import pyarrow as pa
from pyspark.sql import functions as F

from waybill.llm.common import components, file_system, shared_dir, trimmed, written_by_workers
from waybill.llm.suffix_dedup import remove_repeats


def rows_of(df):
    return sorted(map(repr, df.collect()))


def local(path):
    return file_system(path)[1]


def test_workers_write_what_spark_would(spark):
    df = spark.range(0, 5000, 1, 3).selectExpr(
        "id", "if(id % 7 = 0, null, cast(id as int)) as i", "id % 2 = 0 as b", "id / 3 as d",
        "if(id % 5 = 0, null, unhex(md5(cast(id as string)))) as x", "named_struct('p', id, 'q', if(id % 3 = 0, null, id)) as s",
    )
    out, path = written_by_workers(spark, df, "flat")
    assert rows_of(out) == rows_of(df)
    assert out.dtypes == df.dtypes
    parts = os.listdir(local(path))
    # Hadoop's local file system starts a process for every file it makes, and puts a checksum file beside it.
    assert len(parts) == 3 and all(p.startswith("part-") for p in parts), parts


def test_attempts_that_do_not_count_are_not_read(spark):
    out, path = written_by_workers(spark, spark.range(10), "flat")
    part = glob.glob(f"{local(path)}/part-*")[0]
    with open(part, "rb") as a, open(f"{local(path)}/_attempt-lost.parquet", "wb") as b:
        b.write(a.read())
    assert spark.read.parquet(path).count() == 10


def test_no_rows_and_other_types(spark):
    out, _ = written_by_workers(spark, spark.range(10).where("id > 99"), "flat")
    assert out.columns == ["id"] and out.collect() == []
    df = spark.range(5).select("id", F.col("id").cast("string").alias("t"), F.array("id").alias("a"))
    assert rows_of(written_by_workers(spark, df, "texts")[0]) == rows_of(df)


def test_functions_of_batches_are_applied_on_the_way(spark):
    def twice(batches):
        for batch in batches:
            values = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array([[v] * (v % 3) for v in values])], ["v", "l"])

    out, _ = written_by_workers(spark, spark.range(100), "made", (twice, "v long, l array<long>"))
    assert rows_of(out) == sorted(f"Row(v={v}, l={[v] * (v % 3)})" for v in range(100))


def test_working_tables_start_no_processes(spark):
    """Neither rounds of components nor the tables of op6 leave the checksum files of Hadoop's local file system."""
    folder = local(shared_dir(spark))
    before = set(glob.glob(f"{folder}/waybill-*"))
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a long, b long")
    assert {(r.node, r.root) for r in components(spark, edges).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
    text = " ".join(f"word{i}" for i in range(200))
    docs = spark.createDataFrame([(1, "a " + text), (2, text + " b"), (3, text), (4, text)], "doc_id long, text string")
    assert all(r.spans for r in remove_repeats(spark, docs).collect())
    made = set(glob.glob(f"{folder}/waybill-*")) - before
    assert made and not [p for m in made for p in os.listdir(m) if p.endswith(".crc")]


def test_workers_give_memory_back():
    import re

    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) / 1024

    def run(batches):
        held = [bytes(50_000) for _ in range(4000)]  # pieces that malloc keeps behind the last one when they go
        tail.append(bytes(50_000))
        yield from (batches, len(held))

    tail = []
    before = resident()
    assert list(trimmed(run)([1])) == [[1], 4000]
    assert resident() - before < 100
