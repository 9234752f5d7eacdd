"""Service log lines: ``time | LEVEL | logger | message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Log folder -> job label
JOBS = {
    "api": "api",
    "kafka_consumer": "kafka_consumer",
    "kafka_producer_orders": "kafka_producer",
    "kafka_producer_payments": "kafka_producer",
    "kafka_producer_shipments": "kafka_producer",
}
# Time format, and the width the level is padded to
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LEVEL_WIDTH = 8


def render_line(ts: Column, level: Column, logger: Column, message: Column) -> Column:
    padded = F.rpad(level, F.greatest(F.length(level), F.lit(LEVEL_WIDTH)), F.lit(" "))
    return F.concat_ws(" | ", F.date_format(ts, TIME_FORMAT), padded, logger, message)


def job_label(path: Column) -> Column:
    """Job of a log file by its folder; ``key=value`` folder names count by value."""
    folder = F.regexp_extract(path, r"([^/=]+)/[^/]*$", 1)
    pairs = [F.lit(part) for pair in JOBS.items() for part in pair]
    return F.element_at(F.create_map(*pairs), folder)


def parse_lines(lines: DataFrame) -> DataFrame:
    """``value, path`` -> ts, level, logger, message, job, line.

    A line that does not follow the format, such as part of a traceback, keeps
    its text in ``line`` and has NULL fields.
    """
    parts = F.split("value", " [|] ", 4)
    ts = F.try_to_timestamp(F.get(parts, F.lit(0)), F.lit(TIME_FORMAT))
    fits = (F.size(parts) == 4) & ts.isNotNull()

    def part(i: int) -> Column:
        return F.when(fits, F.get(parts, F.lit(i)))

    return lines.select(
        F.when(fits, ts).alias("ts"),
        F.trim(part(1)).alias("level"),
        part(2).alias("logger"),
        part(3).alias("message"),
        job_label(F.col("path")).alias("job"),
        F.col("value").alias("line"),
    )


def log_scan(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """All log files below ``path``, once or as they grow in number."""
    reader = spark.readStream if streaming else spark.read
    files = reader.option("recursiveFileLookup", "true").text(path)
    return parse_lines(files.select("value", F.col("_metadata.file_path").alias("path")))
