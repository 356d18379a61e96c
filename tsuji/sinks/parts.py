"""Per-mesh parts, merging them, staging loads and reconciling outputs."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geom, wkb
from ..operators import search
from ..session import arrow_fs, publish, ship_package, version_path
from .partitioned import read_partitions_as_text


def write_parts(df: DataFrame, path: str, mesh_col: str = "source_mesh", spread: bool = True) -> str:
    """One folder per mesh; rewriting a mesh replaces only that mesh's folder (dynamic overwrite).

    The rebalance hint lets AQE deal rows by mesh into partitions of the advisory size: small meshes
    share a task, a mesh holding most of all rows is split over many."""
    out = df.hint("rebalance", mesh_col) if spread else df
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(mesh_col).parquet(path))
    return path


def part_paths(spark: SparkSession, root: str, mesh_col: str = "source_mesh") -> list[str]:
    """The mesh folders under ``root``, sorted (S4: the sort fixes the part order)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    out = [s.getPath().toString() for s in fs.listStatus(p)
           if s.isDirectory() and s.getPath().getName().startswith(f"{mesh_col}=")]
    return sorted(out)


def _safe_cast(col: str, src_type, dst_type):
    """Cast that raises when a value changes (pyarrow's safe-cast rule); Spark's cast of 1.5 to
    smallint would silently give 1."""
    c = F.col(col)
    if src_type == dst_type:
        return c
    cast = c.cast(dst_type)
    lossless = cast.cast(src_type).eqNullSafe(c)
    return F.when(lossless, cast).otherwise(
        F.raise_error(F.concat(F.lit(f"unsafe cast of {col} to {dst_type.simpleString()}: "), c.cast("string")))
        .cast(dst_type)).alias(col)


ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"      # where Spark's writer leaves the schema


def _plain(path: str) -> str:
    """A path in the form in which listing and caller can be compared."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def part_schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[T.StructType]]:
    """The different schemas of every part's files: one job, whose tasks open the footers of a batch of
    files each; a row per part and schema comes back."""
    ship_package(spark)
    known = {_plain(p): p for p in paths}

    def read(batches):
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            part, schema = [], []
            for path in batch.column("path").to_pylist():
                folder = _plain(path)
                while folder and folder not in known:
                    folder = folder.rpartition("/")[0]
                fs, p = arrow_fs(path)
                with fs.open_input_file(p) as src:
                    footer = pq.read_metadata(src)
                own = (footer.metadata or {}).get(ROW_METADATA)
                part.append(known.get(folder))
                schema.append(own.decode() if own else from_arrow_schema(footer.schema.to_arrow_schema()).json())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(schema, pa.string())], names=["part", "schema"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(list(paths)).select("path"))
    out: dict[str, list[T.StructType]] = {p: [] for p in paths}
    for r in files.mapInArrow(read, "part string, schema string").distinct().orderBy("part", "schema").collect():
        out[r.part].append(T.StructType.fromJson(json.loads(r.schema)))
    return out


def merge_parts(spark: SparkSession, paths: Sequence[str], base_path: str | None = None) -> DataFrame:
    """All parts under the first part's schema (U1, K2): later parts must have the same field names
    in the same order and are cast to the first part's types, losslessly or not at all.

    Footers are read by one job, however many parts there are; parts of one schema are one scan."""
    if not paths:
        raise ValueError("merge_parts got an empty list of parts")
    schemas = part_schemas(spark, paths)
    first = read_partitions_as_text(spark, paths[0], base_path=base_path).schema
    inside = schemas[paths[0]][0].fieldNames() if schemas[paths[0]] else first.fieldNames()
    folders = [f for f in first.fields if f.name not in inside]      # told by the path, alike for all parts
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        for schema in schemas[p]:
            if schema.fieldNames() != inside:
                names = schema.fieldNames() + [f.name for f in folders]
                raise ValueError(f"part {p} has fields {names}, expected {first.fieldNames()}")
        kinds = {tuple(f.dataType.simpleString() for f in s.fields) for s in schemas[p]}
        if len(kinds) > 1:
            raise ValueError(f"part {p} has files of different types: {sorted(kinds)}")
        groups.setdefault(kinds.pop() if kinds else (), []).append(p)
    out = None
    for same in groups.values():
        df = read_partitions_as_text(spark, *same, base_path=base_path)
        df = df.select(*[_safe_cast(f.name, df.schema[f.name].dataType, f.dataType) for f in first.fields])
        out = df if out is None else out.unionByName(df)
    return out


def write_counted(df: DataFrame, path: str, name: str, fmt: str = "parquet", **options) -> int:
    """Write ``df`` (overwrite) and return the rows written, counted on the way (no second pass)."""
    obs = Observation(name)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    for k, v in options.items():
        w = w.option(k, str(v))
    w.save(path)
    return int(obs.get["rows"])


def reconcile(counts: dict[str, int]) -> None:
    """Two outputs of the same parts must agree on their row count (K4)."""
    if len(set(counts.values())) > 1:
        raise RuntimeError(f"row count mismatch between outputs: {counts}")


def write_geo_metadata(spark: SparkSession, df: DataFrame, path: str, geometry: str = "line") -> dict:
    """Geo metadata of an output (K3): CRS and the true union bbox of all rows, stored as a
    one-row JSON table next to the data (Spark's parquet writer cannot set the footer key)."""
    b = search.total_bounds_row(search.with_bbox(df.select(geometry), geometry))
    meta = {"version": "1.0.0", "primary_column": geometry,
            "columns": {geometry: {"encoding": "native-array", "geometry_types": ["LineString"],
                                   "crs": {"id": {"authority": "EPSG", "code": geom.srid_of(df, geometry)}},
                                   "bbox": [b["xmin"], b["ymin"], b["xmax"], b["ymax"]] if b and b["n"] else None}}}
    spark.createDataFrame([(json.dumps(meta),)], "geo string").coalesce(1).write.mode("overwrite").text(path)
    return meta


def read_geo_metadata(spark: SparkSession, path: str) -> dict:
    """The geo metadata written by ``write_geo_metadata`` (one JSON row)."""
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else {}


def read_geoparquet(spark: SparkSession, *paths: str, geometry: str = "geometry", srid: int | None = None) -> DataFrame:
    """Parquet whose ``geometry`` column holds WKB lines, in the native form. The CRS of a GeoParquet
    footer is not visible to Spark's reader; pass ``srid`` to tag the column."""
    df = spark.read.parquet(*paths)
    if dict(df.dtypes)[geometry] == "binary":
        df = df.withColumn(geometry, wkb.from_wkb(geometry))
    return geom.with_srid(df, geometry, srid) if srid is not None else df


def write_wkb(df: DataFrame, path: str, geometry: str = "geometry") -> str:
    """``df`` as parquet with ``geometry`` as WKB, for tools that read GeoParquet columns; the metadata
    beside it is ``write_geo_metadata``'s."""
    df.withColumn(geometry, wkb.to_wkb(geometry)).write.parquet(path)
    return path


def load_stage(spark: SparkSession, paths: Sequence[str], table: str, base_path: str | None = None) -> int:
    """Truncate + append of all parts into the stage table (K6): a new version of ``table``,
    published when it is complete. Returns the rows loaded."""
    if not paths:
        raise ValueError("load_stage got an empty list of parts")
    new = version_path(table)
    n = write_counted(read_partitions_as_text(spark, *paths, base_path=base_path), new, "load_stage")
    publish(spark, table, new)
    return n


def load_stage_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                    num_partitions: int | None = None) -> None:
    """Truncate-and-append into an existing database table through Spark's JDBC writer (K6).

    ``truncate=true`` with overwrite keeps the table's declared schema (the stage table is never
    re-created from an inferred schema); ``numPartitions`` bounds the concurrent connections.
    Not exercised by the tests: no database server is available here.
    """
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("truncate", "true").mode("overwrite"))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
