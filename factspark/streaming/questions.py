"""Questions and request events as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factspark.functions import text


def new_questions(stream: DataFrame, question_col: str = "question", time_col: str = "ts", horizon: str = "1 hour") -> DataFrame:
    """Questions of a stream that weren't asked within the horizon (by their text without white space around it)."""
    keyed = stream.withColumn("question_key", text.strip(F.col(question_col)))
    return keyed.withWatermark(time_col, horizon).dropDuplicatesWithinWatermark(["question_key"])


def event_counts(stream: DataFrame, time_col: str = "ts", key_col: str = "event_type", window: str = "1 day", late: str = "1 day") -> DataFrame:
    """``(start, key, n, total)``: events by window and kind, once no later ones can come."""
    groups = stream.withWatermark(time_col, late).groupBy(F.window(time_col, window).alias("w"), F.col(key_col).alias("key"))
    return groups.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "key", "n", "total")


def read_json_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Records that are dropped into a folder as JSON lines."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Takes in what is there, appends the result as Parquet, and stops; the checkpoint makes a repeated run exact."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
