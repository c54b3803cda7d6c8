"""Cleaning as a stream: new files are treated and judged in micro-batches and land in the lake's partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import quality
from ..operators.contracts import TableContract, conform
from ..plans.pipeline import clean
from ..sources.lake import PARTITION


def clean_stream(spark: SparkSession, source: str, schema: StructType, contract: TableContract, path: str, checkpoint: str, date_of: str, format: str = "json") -> StreamingQuery:
    """Process all files not seen before and stop. Rows are partitioned by the date of the ``date_of`` column.

    Uniqueness holds inside a batch. A batch that is run again replaces what it wrote, as files carry its number.
    """
    rows = spark.readStream.schema(schema).format(format).load(source)

    def write(batch: DataFrame, number: int) -> None:
        approved, _ = quality.split_by_quality(conform(clean(batch, contract), contract))
        dated = approved.withColumn(PARTITION, F.coalesce(F.date_format(date_of, "yyyy-MM-dd"), F.lit("unknown"))).withColumn("batch", F.lit(number))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", PARTITION).parquet(path)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
