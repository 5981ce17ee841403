"""The event topic as a stream or as a bounded replay.

Any source with the columns of :data:`tidemark.schemas.TOPIC` will do; Kafka has them, and a folder of
Parquet files with the same columns stands in for it where no broker is available.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.ordered import ROWS_PER_SLICE
from tidemark.session import staged

DEFAULT_TOPIC = "events"


def stream_topic(
    spark: SparkSession, brokers: str, topic: str = DEFAULT_TOPIC, max_offsets: int | None = None
) -> DataFrame:
    """Stream from the earliest offset; the query's checkpoint resumes where the last batch ended."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def replay_topic(spark: SparkSession, brokers: str, topic: str = DEFAULT_TOPIC) -> DataFrame:
    """The whole retained topic as a bounded table."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def stream_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.TOPIC)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def replay_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.TOPIC).parquet(path)


def with_seq(log: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add ``seq``, the total order used by every rule: time, then partition, then offset.

    Inside a partition the offset alone decides, as broker times may go back: a message counts as no earlier than
    any before it in its partition. Only places and times are scanned for that, in blocks of offsets; the messages are
    joined with what was found only if some time did go back.
    """
    places = log.select("partition", "offset", "timestamp").withColumn("_block", F.floor(F.col("offset") / rows_per_slice))
    upto = Window.partitionBy("partition", "_block").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("partition").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.groupBy("partition", "_block").agg(F.max("timestamp").alias("_top")).withColumn("_carried", F.max("_top").over(earlier))
    ranked = places.withColumn("_near", F.max("timestamp").over(upto)).join(carried.drop("_top"), ["partition", "_block"])
    late = ranked.select("partition", "offset", "timestamp", F.greatest("_near", "_carried").alias("_time")).where("_time > timestamp")
    late = staged(late.select("partition", "offset", "_time"))
    if late.isEmpty():
        return log.withColumn("seq", F.struct("timestamp", "partition", "offset"))
    at = F.coalesce("_time", "timestamp").alias("timestamp")
    return log.join(late, ["partition", "offset"], "left").select(*log.columns, F.struct(at, "partition", "offset").alias("seq"))
