"""Incremental forms of batch operators: new files only, with the state kept by the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.functions import text as T


def new_files(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the Parquet files that a folder gets; files seen once are not read again."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def pending_documents(stream: DataFrame, key: str, url: str, extensions: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """Append each document with a readable address to ``out`` once over all batches, by an anti-join with what is there."""

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.where(F.col(key).isNotNull() & T.has_extension(F.col(url), extensions)).groupBy(key).agg(F.min(url).alias(url))
        try:
            fresh = fresh.join(spark.read.parquet(out).select(key), key, "left_anti")
        except Exception as error:  # noqa: BLE001 - the first batch finds no folder
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
        fresh.write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def edge_counts(stream: DataFrame) -> DataFrame:
    """Running weights of undirected edges: a stateful count per (a, b, kind, dataset), for update mode."""
    ends = stream.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "kind", "dataset")
    return ends.groupBy("a", "b", "kind", "dataset").agg(F.count("*").alias("weight"))


def fresh_signals(stream: DataFrame, at: str, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Events counted per signal and window of event time; events later than ``late`` after the watermark are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), "signal").agg(F.count("*").alias("n"), F.max(at).alias("latest"))
