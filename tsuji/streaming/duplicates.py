"""Geometry shared between meshes, flagged as the meshes arrive (T1 with U2).

After each micro-batch the rows flagged so far are those that ``quality.cross_mesh_duplicates`` finds in everything
delivered so far. State is a log of Parquet folders, one per micro-batch: the rows with their geometry's key. A batch
is held against the log at once, by one aggregate and one join on the key, not row by row against a state store: so
time is that of reading and shuffling rows, and state is some 40 bytes a row. Where a batch is small against the log
its keys are broadcast, and earlier rows are read but not shuffled.

A geometry's key is the SHA-256 of its text form, which keeps every double in full and the sign of zeros. A geometry
is one row a task to the aggregate's exchange and one row to the join, so one geometry may hold any share of the rows.

Exactly once: a batch's folders are overwritten when it is run again, and the file sink that appends to the table
takes a batch's folder only when it is whole, and each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "fid long, source_mesh string"
ROW_COLUMNS = ("fid", "source_mesh")
FEW = 500_000                   # rows of a batch whose keys are broadcast, as one long each
ROW_GROUP = 16 << 20            # of the log: as many tasks as there are groups read it
STATE = "spark.sql.streaming.stateStore."
# state on disk, of which a bounded part is in memory; a commit writes the changes; a join's state is one store
STATE_CONF = {f"{STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              f"{STATE}rocksdb.boundedMemoryUsage": "true", f"{STATE}rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.join.stateFormatVersion": "3"}


def _keyed(df: DataFrame, geom_col: str = "line", key_col: str = "fid", mesh_col: str = "source_mesh") -> DataFrame:
    return df.where(F.col(geom_col).isNotNull()).select(
        F.unhex(F.sha2(F.col(geom_col).cast("string"), 256)).alias("geometry"), F.col(key_col).cast("long").alias("fid"), F.col(mesh_col).alias("source_mesh"))


def shared_geometries(stream: DataFrame, geom_col: str = "line", key_col: str = "fid", mesh_col: str = "source_mesh") -> DataFrame:
    """``fid, source_mesh`` of a stream's rows whose geometry two meshes have delivered, each once. Null
    geometries are never flagged; a null mesh is no mesh, but its rows are flagged with the others.

    As a stream for a sink of one's own, with the state in the state store (set ``STATE_CONF``): some ten lookups
    a row, which suits few rows a batch; ``run`` is for deliveries of any size."""
    rows = _keyed(stream, geom_col, key_col, mesh_col)
    named = rows.where(F.col("source_mesh").isNotNull()).select("geometry", F.col("source_mesh").alias("mesh"))
    first = named.dropDuplicates(["geometry"]).select(F.col("geometry").alias("first_geometry"), F.col("mesh").alias("first_mesh"))
    second = named.join(first, (F.col("geometry") == F.col("first_geometry")) & (F.col("mesh") != F.col("first_mesh")))
    shared = second.select(F.col("geometry").alias("shared_geometry")).dropDuplicates(["shared_geometry"])
    return rows.join(shared, F.col("geometry") == F.col("shared_geometry")).select("fid", "source_mesh")


def _shared_now(rows: DataFrame, batch_id: int) -> DataFrame:
    """``geometry, known`` of the geometries of batch ``batch_id`` that two meshes have delivered by now;
    ``known``: two had before it."""
    new = F.col("batch") == batch_id
    if rows.where(new).count() <= FEW:
        short = F.xxhash64("geometry")                # lets through all rows of the batch's geometries, and hardly another
        keys = rows.where(new).select(short.alias("short")).distinct()
        rows = rows.where(new).unionByName(rows.where(~new).withColumn("short", short).join(F.broadcast(keys), "short", "left_semi").drop("short"))
    before = F.when(~new, F.col("source_mesh"))
    return (rows.groupBy("geometry")
            .agg(F.min("source_mesh").alias("lo"), F.max("source_mesh").alias("hi"), F.min(before).alias("lo_before"), F.max(before).alias("hi_before"),
                 F.max("batch").alias("last"))
            .where((F.col("last") == batch_id) & (F.col("lo") != F.col("hi")))
            .select("geometry", F.coalesce(F.col("lo_before") != F.col("hi_before"), F.lit(False)).alias("known")))


def run(spark: SparkSession, landing: str, table: str, checkpoint: str, schema, files_per_batch: int = 1) -> int:
    """Flag the rows of all Parquet files in ``landing`` not yet recorded in ``checkpoint``, appending to
    ``table``. Returns the number of micro-batches. The log of keyed rows is kept below ``checkpoint``;
    a checkpoint begun by a state store has none and is refused."""
    log, shared, flagged = (f"{checkpoint}/{name}" for name in ("rows", "shared", "flagged"))
    keyed = _keyed(spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_batch)).option("recursiveFileLookup", "true")
                   .parquet(landing))
    logged, row = T.StructType([*keyed.schema, T.StructField("batch", T.LongType())]), keyed.select(*ROW_COLUMNS).schema

    def flag(batch: DataFrame, batch_id: int) -> None:
        if not _whole(spark, f"{flagged}/{batch_id}"):
            batch.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(f"{log}/batch={batch_id}")
            # each batch by name: a log that lacks one is an error
            rows = spark.read.schema(logged).option("basePath", log).parquet(*[f"{log}/batch={k}" for k in range(batch_id + 1)])
            _shared_now(rows, batch_id).write.mode("overwrite").parquet(f"{shared}/{batch_id}")
            (rows.join(spark.read.parquet(f"{shared}/{batch_id}"), "geometry").where((F.col("batch") == batch_id) | ~F.col("known"))
             .select(*ROW_COLUMNS).write.mode("overwrite").parquet(f"{flagged}/{batch_id}"))
        (spark.readStream.schema(row).option("recursiveFileLookup", "true").parquet(flagged)
         .writeStream.format("parquet").option("path", table).option("checkpointLocation", f"{checkpoint}/published")
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())

    query = keyed.writeStream.foreachBatch(flag).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)


def _whole(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has been committed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
