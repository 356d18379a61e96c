"""LIST-style partitioned table with a DEFAULT bucket (K8), read back with pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_COL = "part"
DEFAULT_PART = "default"


def list_partition(key, values: Sequence[str], default: str = DEFAULT_PART):
    """Partition value: the key itself when listed, else the DEFAULT bucket."""
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k.isin(list(values)), k).otherwise(F.lit(default))


def write_list_partitioned(df: DataFrame, path: str, key: str, values: Sequence[str], *,
                           spread: bool = True, dynamic: bool = False) -> str:
    """Write ``df`` partitioned by ``part`` (listed values + DEFAULT).

    The rebalance hint lets AQE deal rows by part into partitions of the advisory size, so a part
    holding a third of the data is written by many tasks and small parts share one.
    ``dynamic`` replaces only the partitions present in ``df``; otherwise the table is replaced.
    """
    out = df.withColumn(PART_COL, list_partition(key, values))
    if spread:
        out = out.hint("rebalance", PART_COL)
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(PART_COL).parquet(path))
    return path


def read_list_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read the table with ``part`` kept as a string (no '01' -> 1 type inference)."""
    if schema is not None:
        if PART_COL not in schema.fieldNames():
            schema = T.StructType(schema.fields + [T.StructField(PART_COL, T.StringType())])
        return spark.read.schema(schema).parquet(path)
    return read_partitions_as_text(spark, path, base_path=path)


def read_partitions_as_text(spark: SparkSession, *paths: str, base_path: str | None = None) -> DataFrame:
    """Read partitioned parquet keeping partition values as strings ('3622', '01' stay text)."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    old = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        r = spark.read.option("basePath", base_path) if base_path else spark.read
        return r.parquet(*paths)
    finally:
        spark.conf.set(key, old)


def key_filter(df: DataFrame, key: str, values: Sequence[str], listed: Sequence[str]) -> DataFrame:
    """``key IN values`` plus the implied predicate on ``part`` so the scan prunes partitions.

    Listed values live in their own partition; unlisted ones can only be in DEFAULT.
    """
    parts = sorted({v if v in listed else DEFAULT_PART for v in values})
    return df.where(F.col(PART_COL).isin(parts) & F.col(key).isin(list(values)))


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows in each partition."""
    return df.groupBy(PART_COL).agg(F.count(F.lit(1)).alias("n"))


def partitions_touched(df: DataFrame) -> DataFrame:
    """Partitions (directories) that matching rows came from."""
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), f"{PART_COL}=([^/]+)", 1).alias(PART_COL)).distinct()
