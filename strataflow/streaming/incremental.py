"""Incremental layers with Structured Streaming: new wide files become long rows once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataflow.operators.join import sized, split
from strataflow.plans.pipeline import LONG, tagged_long


def stream_silver(spark: SparkSession, source: str, schema: StructType, dim: DataFrame, out: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Takes the files of `source` that the checkpoint has not seen. A batch's files are named by its number and
    overwritten if it is run again, so a retry repeats no row."""

    dim = sized(dim)  # counted once, not in each batch

    def write(batch: DataFrame, number: int) -> None:
        both = tagged_long(batch, dim, measured=True).persist()  # two writes, one join
        matched, unmatched = split(both, LONG)
        matched.write.mode("overwrite").partitionBy("tissue_id").parquet(f"{out}/batch={number}")
        unmatched.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        both.unpersist()

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
