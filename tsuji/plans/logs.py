"""HTTP-log and download work-list queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import transfer
from ..session import scratch_path
from ..sources import fetch
from ..sources import fixtures as fx


def http_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: every log message split into method, status, range, length and total size."""
    return transfer.parse_log(fx.http_log(spark, sf_dir))


def transfer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: bytes transferred per probe and the share of the full file."""
    return transfer.summarize_transfer(transfer.parse_log(fx.http_log(spark, sf_dir)), by=["probe"])


def fetch_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs still to download; every third page's file is there, every sixth one empty."""
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    there = (pages.where("page_id % 3 = 0").withColumn("name", text.url_file_name("url")).where("name <> ''")
             .groupBy("name").agg(F.max(F.when(F.col("page_id") % 6 == 0, 0).otherwise(1)).cast("long").alias("length")))
    path = scratch_path(spark, "listing")
    there.write.parquet(path)
    return fetch.worklist(pages, spark.read.parquet(path)).select("page_id", "url", "name")
