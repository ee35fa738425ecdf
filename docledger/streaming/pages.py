"""An optional extension beyond the reference: pages as they arrive, each extracted once.

Late copies of a page are dropped within the watermark; extraction is the batch extraction, as it is narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docledger.operators import extract

PAGE = "document_id string, relative_path string, page_number int, text string, month_number int, year int, seen timestamp"


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(PAGE).parquet(folder)


def extracted(pages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Records of the pages, each (document, page) once within the delay."""
    once = pages.withWatermark("seen", delay).dropDuplicatesWithinWatermark(["document_id", "page_number"])
    return extract.records(once)


def hourly_counts(pages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Pages by hour of arrival, late ones within the delay included."""
    return pages.withWatermark("seen", delay).groupBy(F.window("seen", "1 hour").alias("hour")).agg(F.count(F.lit(1)).alias("pages")).select("hour.start", "pages")


def start(frame: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return frame.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
