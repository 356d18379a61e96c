"""Spatially ordered parquet layout (K5) and the bbox-filtered read that exploits it.

Hilbert-sorting the rows makes each row group's ``bbox.*`` min/max statistics tight, so a
covering predicate lets the parquet reader skip most row groups (the reference measured
92.6 MB -> 12.4 MB transferred for the same answer). With a packed R-tree over the layout's files
(``rtree``) it stands in for an indexed vector file: files the tree rules out are not opened at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geom
from ..operators import search
from . import rtree

DEFAULT_ROW_GROUP_ROWS = 10_000      # a few megabytes of lines: small enough to prune, large enough to read


def hilbert_order(df: DataFrame, line: str = "line", bbox: str = "bbox", out: str = "hilbert",
                  total: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Attach the Hilbert index of each bbox centre over the table's total bounds.

    ``total`` may be passed when the bounds are already known (e.g. from the geo metadata written
    at merge time); otherwise they are one global aggregate, brought back as four numbers and
    inlined as literals (no join with the data).
    """
    if bbox not in df.columns:
        df = search.with_bbox(df, line, bbox)
    if total is None:
        t = search.total_bounds_row(df, bbox)
        if t is None or t["n"] == 0:
            return df.withColumn(out, F.lit(None).cast("long"))
        total = (t["xmin"], t["ymin"], t["xmax"], t["ymax"])
    return geom.with_hilbert(df, bbox, total, out)


def write_covering_layout(df: DataFrame, path: str, *, line: str = "line", key: str = "fid",
                          num_files: int | None = None, row_group_rows: int = DEFAULT_ROW_GROUP_ROWS,
                          total: tuple[float, float, float, float] | None = None, file_rows: int | None = None) -> str:
    """Write ``df`` with a ``bbox`` covering column, globally Hilbert-sorted, in small row groups.

    One range shuffle on the Hilbert code (``key`` breaks ties so the order is total and
    reruns are identical), then a sort inside each partition. Always overwrites: a rerun never
    appends to the previous output. With ``file_rows`` a file ends after so many rows, and a packed R-tree
    over the files is written beside them, from which ``read_bbox`` picks the files to open.
    """
    ordered = hilbert_order(df, line, total=total)
    by = ["hilbert", key]
    # without a number AQE sizes the ranges from the shuffled bytes
    ranged = ordered.repartitionByRange(num_files, *by) if num_files else ordered.repartitionByRange(*by)
    (ranged
     .sortWithinPartitions("hilbert", key)
     .drop("hilbert")
     .write.mode("overwrite")
     .option("parquet.block.row.count.limit", str(row_group_rows))
     .option("parquet.block.size", str(128 * 1024 * 1024))
     .option("maxRecordsPerFile", str(file_rows or 0))
     .parquet(path))
    if file_rows:
        rtree.build_index(df.sparkSession, path)
    return path


def read_bbox(spark: SparkSession, path: str, box: search.Box, line: str = "line") -> DataFrame:
    """bbox-filtered read (S6): only the files the index hits, if the layout has one; covering predicate
    pushed to the scan, then the exact test."""
    rows = rtree.read_hit(spark, path, box) if rtree.has_index(spark, path) else spark.read.parquet(path)
    return search.intersecting(rows, box, line, "bbox")
