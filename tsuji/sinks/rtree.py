"""Packed Hilbert R-tree over the files of a layout (K5, S6): which files a box can touch.

A Hilbert-ordered layout keeps neighbours together, so its files, taken in the layout's order, are the
leaves of a packed R-tree: every ``fanout`` of them share a parent whose box is the union of theirs, and so on
up to one root. The tree is a small table beside the data, one row per node and level. A search goes down level
by level, each level a join with the nodes hit above, and gives the files to open; all others are never
opened, not even for their footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search
from ..operators.ids import dense_id

FANOUT = 64
INDEX = "_index"                  # below the layout; readers skip folders that begin with an underscore
SIDES = ("xmin", "ymin", "xmax", "ymax")


def _union() -> list:
    return [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
            F.sum("rows").alias("rows")]


def build_index(spark: SparkSession, path: str, bbox: str = "bbox", fanout: int = FANOUT) -> str:
    """Write the tree of the layout at ``path``. One scan of the box column gives the leaves; a level above
    has a ``fanout``-th of the rows below, so there are few levels and only the lowest is of any size.
    A file whose rows have no box is a leaf that no search hits."""
    rows = spark.read.parquet(path).select(*[F.col(bbox)[s].alias(s) for s in SIDES], F.col("_metadata.file_path").alias("file"),
                                           F.when(F.col(bbox)["xmin"].isNotNull(), 1).otherwise(0).alias("rows"))
    leaves = dense_id(rows.groupBy("file").agg(*_union()), ["file"], out="node", start=0)
    out, level = f"{path.rstrip('/')}/{INDEX}", 0
    nodes = leaves.select("node", "file", *SIDES, "rows")
    while True:
        nodes = nodes.withColumn("parent", F.expr(f"node div {fanout}"))
        folder = f"{out}/level={level}"
        nodes.write.mode("overwrite").parquet(folder)            # written by level: the next one reads it
        nodes = spark.read.parquet(folder)
        if nodes.limit(2).count() < 2:
            return out
        nodes = (nodes.groupBy(F.col("parent").alias("node")).agg(*_union())
                 .select("node", F.lit(None).cast("string").alias("file"), *SIDES, "rows"))
        level += 1


def has_index(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{INDEX}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def hit_files(spark: SparkSession, path: str, box: search.Box) -> DataFrame:
    """``file`` of every leaf whose box overlaps ``box``: one join per level, from the root down."""
    x0, y0, x1, y1 = (float(v) for v in box)
    tree = (spark.read.parquet(f"{path.rstrip('/')}/{INDEX}")
            .where((F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)))
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{INDEX}")
    levels = sum(1 for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
                 if s.getPath().getName().startswith("level="))
    hits = tree.where(F.col("level") == levels - 1)
    for level in range(levels - 2, -1, -1):
        below = tree.where(F.col("level") == level)
        hits = below.join(hits.select(F.col("node").alias("parent")), "parent", "left_semi")
    return hits.select("file")


def read_hit(spark: SparkSession, path: str, box: search.Box) -> DataFrame:
    """The layout's rows in the files a search hits; a listing of no other file is made. Rows outside the
    box are still among them: filter as on the whole layout."""
    files = [r.file for r in hit_files(spark, path, box).collect()]           # names of the files to open
    schema = spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
