"""Incremental ingest with Structured Streaming.

New mesh archives landing in a folder are picked up by a file-source stream; the checkpoint
records which files are done (the downloader's "skip what exists", made exactly-once), and each
micro-batch is written with ``foreachBatch`` to its own batch folder, overwritten on a retry, so
a replayed batch never duplicates rows. ``Trigger.AvailableNow`` processes what is there and
stops, which is how a scheduled batch job uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import warehouse as wh
from ..sources import geojson


# the binaryFile source's fixed schema (streams must declare it)
BINARY_FILE_SCHEMA = T.StructType([T.StructField("path", T.StringType()),
                                   T.StructField("modificationTime", T.TimestampType()),
                                   T.StructField("length", T.LongType()),
                                   T.StructField("content", T.BinaryType())])


def _archives_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None) -> DataFrame:
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.zip")
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = r.load(landing).select("path")            # archives are opened by path inside the task
    raw = files.mapInArrow(geojson._read_archives, geojson.RAW).repartition("file_name", "feature_no")
    # a stream's columns are fixed beforehand: unknown attributes stay in the ``properties`` map
    return geojson.with_attributes(geojson.parsed(raw), list(geojson.COLUMN_MAP))


def incremental_ingest(spark: SparkSession, landing: str, table: str, checkpoint: str,
                       max_files_per_trigger: int | None = None) -> int:
    """Ingest every archive in ``landing`` not yet recorded in ``checkpoint`` into ``table``
    (parquet, partitioned by ``source_mesh``), attributes, geometry of any type and all. The rows of
    an archive are dealt out before they are parsed and written. Returns the number of micro-batches."""
    stream = wh.normalize_roads(_archives_stream(spark, landing, max_files_per_trigger), file_col="file_name")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "source_mesh").parquet(table))

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(q.recentProgress)
