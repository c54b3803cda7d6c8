"""Date-partitioned Parquet tables with processed markers, on any file system that Spark reaches."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

PARTITION = "ingest_date"


@dataclass(frozen=True)
class Lake:
    root: str = field(default_factory=lambda: os.environ.get("LAKEHOUSE_DIR", "lakehouse"))

    def path(self, layer: str, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{dataset}"


def _file(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _file(spark, path)
    fs.delete(folder, True)


def write_partition(df: DataFrame, path: str, date: str, files: int | None = None) -> None:
    """Replace one date's partition and leave the others. ``files`` is for small tables: as many output files."""
    dated = df.withColumn(PARTITION, F.lit(date))
    dated = dated.repartition(files) if files else dated
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)


def read_partition(spark: SparkSession, path: str, date: str) -> DataFrame:
    """One date's rows without the partition column; only that directory is read."""
    return spark.read.parquet(path).where(F.col(PARTITION).cast("string") == date).drop(PARTITION)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole table, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def is_processed(spark: SparkSession, path: str, date: str) -> bool:
    fs, marker = _file(spark, f"{path}/_markers/{date}")
    return fs.exists(marker)


def mark_processed(spark: SparkSession, path: str, date: str) -> None:
    fs, marker = _file(spark, f"{path}/_markers/{date}")
    fs.create(marker, True).close()


def write_csv(df: DataFrame, path: str) -> None:
    """A report as one CSV file with a header."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
