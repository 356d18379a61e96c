"""Scan-cost report (X1): which row groups — and how many bytes — each probe must read.

The reference measured bytes transferred per query from HTTP logs. Here the same question is
answered from the layout itself: one Spark task per batch of files reads only the parquet
footers (pyarrow, no data pages) and emits one row per row group with the compressed size of
every column chunk and the min/max statistics of the covering columns; the probes are then plain
aggregations over that table. It grows with the number of row groups, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.search import TOKYO_STATION_BOX
from .geometry import covering_file

RG_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("row_group", T.IntegerType()),
    T.StructField("num_rows", T.LongType()), T.StructField("column", T.StringType()),
    T.StructField("bytes", T.LongType()), T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()),
])


def _footer_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    from ..session import arrow_fs

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            fs, p = arrow_fs(path)
            with fs.open_input_file(p) as fh:
                md = pq.ParquetFile(fh).metadata
            for rg in range(md.num_row_groups):
                g = md.row_group(rg)
                for c in range(g.num_columns):
                    col = g.column(c)
                    st = col.statistics
                    has = st is not None and st.has_min_max and isinstance(st.min, (int, float))
                    rows.append((path, rg, g.num_rows, col.path_in_schema, col.total_compressed_size,
                                 float(st.min) if has else None, float(st.max) if has else None))
        yield pd.DataFrame(rows, columns=[f.name for f in RG_SCHEMA.fields])


def row_group_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row per (file, row group, column chunk) of the parquet dataset at ``path``."""
    # distributed listing: only the path column is selected, so file contents are never read
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .option("recursiveFileLookup", "true").load(path).select("path"))
    n = spark.sparkContext.defaultParallelism
    return listing.repartition(n).mapInPandas(_footer_rows, RG_SCHEMA)


def scan_cost(spark: SparkSession, path: str, box=TOKYO_STATION_BOX) -> DataFrame:
    """Per probe: row groups and compressed bytes that must be read vs the whole dataset.

    Probes mirror the reference's: count(*), count by road_type, exact intersects without the
    covering predicate (every row group, all geometry), covering predicate only, and both.
    """
    x0, y0, x1, y1 = box
    st = row_group_stats(spark, path)
    rg = (st.groupBy("file", "row_group")
          .agg(F.sum("bytes").alias("rg_bytes"),
               F.sum(F.when(F.col("column").startswith("line."), F.col("bytes"))).alias("line_bytes"),
               F.sum(F.when(F.col("column").startswith("bbox."), F.col("bytes"))).alias("bbox_bytes"),
               F.sum(F.when(F.col("column") == "road_type", F.col("bytes"))).alias("type_bytes"),
               F.max(F.when(F.col("column") == "bbox.xmin", F.col("min"))).alias("xmin_lo"),
               F.max(F.when(F.col("column") == "bbox.xmax", F.col("max"))).alias("xmax_hi"),
               F.max(F.when(F.col("column") == "bbox.ymin", F.col("min"))).alias("ymin_lo"),
               F.max(F.when(F.col("column") == "bbox.ymax", F.col("max"))).alias("ymax_hi")))
    # a row group may hold a hit unless its statistics prove every row misses the box
    keep = ((F.col("xmin_lo") <= x1) & (F.col("xmax_hi") >= x0) & (F.col("ymin_lo") <= y1) & (F.col("ymax_hi") >= y0))
    keep = F.coalesce(keep, F.lit(True))
    probes = [
        ("count(*)", F.lit(False), F.lit(0)),
        ("count by road_type", F.lit(True), F.col("type_bytes")),
        ("intersects only", F.lit(True), F.col("line_bytes")),
        ("covering predicate", keep, F.col("bbox_bytes")),
        ("covering and intersects", keep, F.col("bbox_bytes") + F.col("line_bytes")),
    ]
    # one pass over the footer table: every probe's totals in a single aggregate, then unpivoted
    aggs = [F.sum("rg_bytes").cast("long").alias("bytes_total"), F.count(F.lit(1)).alias("row_groups")]
    for k, (_, read, cost) in enumerate(probes):
        aggs += [F.count_if(read).alias(f"r{k}"), F.coalesce(F.sum(F.when(read, cost)), F.lit(0)).cast("long").alias(f"b{k}")]
    totals = rg.agg(*aggs)
    stack = ", ".join(f"'{name}', r{k}, b{k}" for k, (name, _, _) in enumerate(probes))
    out = totals.selectExpr("bytes_total", "row_groups",
                            f"stack({len(probes)}, {stack}) AS (probe, row_groups_read, bytes_read)")
    return out.select("probe", "row_groups_read", "row_groups", "bytes_read", "bytes_total",
                      F.when(F.col("bytes_total") > 0, F.round(F.col("bytes_read") / F.col("bytes_total"), 4))
                      .alias("fraction"))


def scan_cost_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 (rows only): scan cost of the five probes on the Hilbert-sorted covering layout."""
    return scan_cost(spark, covering_file(spark, sf_dir))
