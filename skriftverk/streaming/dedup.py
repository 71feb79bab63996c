"""Exact deduplication of arriving files: batch-equal with availableNow, bounded with a watermark, or against a table of keys."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import content_key, exact_dedup


def stream_jsonl(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def unique_stream(stream: DataFrame, text: str = "text", event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """First rows of each text. With ``event_time`` the state keeps keys for ``late`` only; else it keeps all of them."""
    keyed = stream.withColumn("key", content_key(F.col(text)))
    if event_time:
        return keyed.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["key"])
    return keyed.dropDuplicates(["key"])


def write_once(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """All that has arrived, then stop; a restart goes on after the last committed batch."""
    return df.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def dedup_into(stream: DataFrame, seen_path: str, out: str, checkpoint: str, text: str = "text", order: list[str] | None = None, id_col: str = "id") -> StreamingQuery:
    """Each micro-batch against the table of seen keys; rows and keys are written under the batch's number, so a repeated batch overwrites itself."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            seen = spark.read.parquet(seen_path).filter(F.col("batch") < number).select("key")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # a table that cannot be read must not let duplicates in
                raise
            seen = spark.createDataFrame([], "key string")  # the first batch
        keyed = batch.withColumn("key", content_key(F.col(text)))
        fresh = exact_dedup(keyed.join(seen, "key", "left_anti"), text, order, id_col)[0].persist()
        fresh.drop("key").write.mode("overwrite").json(f"{out}/batch={number}")
        fresh.select("key").write.mode("overwrite").parquet(f"{seen_path}/batch={number}")
        fresh.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
