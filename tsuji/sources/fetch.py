"""Idempotent fetch work-list (S9): which URLs still need downloading.

The download itself (an HTTP client with politeness delays) is a single-machine tool and is not
rebuilt; what carries over is its skip logic, expressed as a join: a URL is done when a file of
its name exists in the destination with size > 0, and a name seen twice is fetched once (the
first URL in order wins, like a sequential downloader that finds the file already there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import url_file_name


def listing(spark: SparkSession, dest_dir: str, glob: str | None = None) -> DataFrame:
    """(name, length) of the files in ``dest_dir`` (S4); file contents are not read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(dest_dir)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "name string, length long")     # nothing is there yet
    return r.load(dest_dir).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")


def worklist(urls: DataFrame, existing: DataFrame, url: str = "url", order: str = "page_id") -> DataFrame:
    """URLs to fetch: named, first per name in ``order``, and not already present with size > 0.

    A URL without a file name is an error, as in the downloader.
    """
    named = urls.withColumn("name", url_file_name(url))
    named = named.withColumn("name", F.when(F.col("name") != "", F.col("name")).otherwise(
        F.raise_error(F.concat(F.lit("URL without a file name: "), F.col(url))).cast("string")))
    # first URL per name: min_by aggregates partially per task, so a hot name is not one task's work
    cols = [c for c in named.columns if c != "name"]
    first = (named.groupBy("name").agg(F.min_by(F.struct(*cols), F.col(order)).alias("_f"))
             .select(*[F.col(f"_f.{c}").alias(c) for c in cols], "name"))
    done = existing.where(F.col("length") > 0).select("name")
    return first.join(done, "name", "left_anti")
