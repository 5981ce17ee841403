"""JSON log lines from files, as batch or stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.log_lines import parse_lines


def read_log_lines(spark: SparkSession, path: str, written_since: datetime | None = None) -> DataFrame:
    """Raw line in ``value`` plus the structured fields.

    ``written_since`` leaves out whole files that were last written before that time.
    """
    lines = spark.read.text(path)
    if written_since is not None:
        lines = lines.filter(F.col("_metadata.file_modification_time") >= F.lit(written_since))
    return parse_lines(lines)


def stream_log_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.readStream.text(path))
