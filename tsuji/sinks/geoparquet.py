"""GeoParquet output (K3, S2): a Spark data source whose files carry the ``geo`` footer.

Every task streams its Arrow batches into one Parquet file in a staging folder and puts the ``geo`` key
(CRS, encoding, covering and the bounding box of the rows it has just written) into that file's footer. The
driver moves the files of the tasks that Spark reports as done into place and drops the staging folder with
whatever failed or repeated attempts left there. Nothing but file names comes to the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions import geom, wkb
from ..session import arrow_fs, ship_package

FORMAT = "geoparquet"
VERSION = "1.1.0"
BOX = ("xmin", "ymin", "xmax", "ymax")


def _geographic(name: str, datum: dict, code: int) -> dict:
    axis = [{"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"}]
    return {"$schema": "https://proj.org/schemas/v0.7/projjson.schema.json", "type": "GeographicCRS", "name": name, **datum,
            "coordinate_system": {"subtype": "ellipsoidal", "axis": axis}, "id": {"authority": "EPSG", "code": code}}


# the two systems in use, as PROJJSON (fixed values)
CRS = {
    4326: _geographic("WGS 84", {"datum": {"type": "GeodeticReferenceFrame", "name": "World Geodetic System 1984", "ellipsoid": {
        "name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563}}}, 4326),
    6668: _geographic("JGD2011", {"datum": {"type": "GeodeticReferenceFrame", "name": "Japanese Geodetic Datum 2011", "ellipsoid": {
        "name": "GRS 1980", "semi_major_axis": 6378137, "inverse_flattening": 298.257222101}}}, 6668),
}


@dataclass
class Written(WriterCommitMessage):
    """A finished file of the staging folder; empty for a task without rows."""

    name: str


class _Bounds:
    """Union of the covering boxes seen so far; null boxes (missing or empty geometries) do not count."""

    def __init__(self):
        self.box: list[float] | None = None

    def add(self, boxes: pa.Array) -> None:
        sides = [pc.min(pc.struct_field(boxes, n)).as_py() for n in BOX[:2]] + [pc.max(pc.struct_field(boxes, n)).as_py() for n in BOX[2:]]
        if None in sides:
            return
        self.box = sides if self.box is None else [min(a, b) for a, b in zip(self.box[:2], sides[:2])] + [
            max(a, b) for a, b in zip(self.box[2:], sides[2:])]


class GeoWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.geometry, self.covering = options["geometry"], options["covering"]
        self.types = [t for t in options.get("types", "").split(",") if t]
        self.srid = int(options["srid"])
        self.row_group_rows = int(options.get("rowgrouprows", 100_000))
        self.job = uuid.uuid4().hex[:12]
        self.schema = schema
        if self.srid not in CRS:
            raise ValueError(f"no CRS text for EPSG:{self.srid}")

    @property
    def staging(self) -> str:
        return f"{self.path}/_staging-{self.job}"                # hidden from readers until it is complete

    def geo(self, box: list[float] | None) -> bytes:
        column = {"encoding": "WKB", "geometry_types": self.types, "crs": CRS[self.srid],
                  "covering": {"bbox": {n: [self.covering, n] for n in BOX}}}
        if box is not None:
            column["bbox"] = box
        return json.dumps({"version": VERSION, "primary_column": self.geometry, "columns": {self.geometry: column}}).encode()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = arrow_fs(self.staging)
        task = TaskContext.get()
        name = f"part-{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex[:12]}.parquet"   # an attempt's own
        out, bounds = None, _Bounds()
        for batch in iterator:
            if out is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{name}")
                out = pq.ParquetWriter(sink, batch.schema)
            bounds.add(batch.column(self.covering))
            out.write_batch(batch, row_group_size=self.row_group_rows)
        if out is None:
            return Written("")
        out.add_key_value_metadata({"geo": self.geo(bounds.box)})
        out.close()
        sink.close()
        return Written(name)

    def _files(self, fs, base: str) -> list[str]:
        return [f.path for f in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if f.is_file]

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = arrow_fs(self.path)
        staging = arrow_fs(self.staging)[1]
        fs.create_dir(base, recursive=True)
        old = self._files(fs, base) if self.overwrite else []
        done = [m.name for m in messages if m is not None and m.name]
        if not done:                                             # an empty table is a file without rows
            from pyspark.sql.pandas.types import to_arrow_schema

            fs.create_dir(staging, recursive=True)
            done = [f"part-00000-{self.job}.parquet"]
            with fs.open_output_stream(f"{staging}/{done[0]}") as sink, pq.ParquetWriter(sink, to_arrow_schema(self.schema)) as out:
                out.add_key_value_metadata({"geo": self.geo(None)})
        for name in done:
            fs.move(f"{staging}/{name}", f"{base}/{name}")
        for path in old:
            fs.delete_file(path)
        fs.delete_dir(staging)

    def abort(self, messages: list[Written | None]) -> None:
        fs, staging = arrow_fs(self.staging)
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


class GeoParquetSource(DataSource):
    """``df.write.format("geoparquet")`` with options ``geometry`` (WKB column), ``covering`` (box column),
    ``srid`` and ``types``. Plain Parquet to every reader."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> GeoWriter:
        return GeoWriter(dict(self.options), schema, overwrite)


def write_geoparquet(df: DataFrame, path: str, *, line: str | None = None, mpoly: str | None = None, geometry: str = "geometry",
                     covering: str = "bbox", srid: int | None = None, mode: str = "overwrite", row_group_rows: int = 100_000) -> str:
    """``df`` as GeoParquet: the native ``line`` or ``mpoly`` column becomes WKB in ``geometry``, with its
    box in ``covering``. ``srid`` defaults to the column's own; a column without one needs it."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(GeoParquetSource)
    source = line or mpoly
    srid = srid if srid is not None else geom.srid_of(df, source)
    if srid is None:
        raise ValueError(f"column {source} has no srid: pass one")
    box = geom.bounds(F.col(line)) if line else geom.bounds(geom.polygon_vertices(mpoly))
    code = wkb.to_wkb(F.col(line)) if line else wkb.multipolygon_to_wkb(F.col(mpoly))
    out = df.withColumn(covering, F.when(F.col(source).isNotNull() & box["xmin"].isNotNull(), box)).withColumn(geometry, code)
    if source != geometry:
        out = out.drop(source)
    (out.write.format(FORMAT).mode(mode).option("geometry", geometry).option("covering", covering).option("srid", str(srid))
     .option("types", "LineString" if line else "MultiPolygon").option("rowGroupRows", str(row_group_rows)).save(path))
    return path


def geo_footers(spark: SparkSession, path: str) -> DataFrame:
    """``file, geo, rows`` of every file below ``path``: footers are read by tasks, a batch of files each."""
    ship_package(spark)

    def read(batches):
        for batch in batches:
            files = batch.column("path").to_pylist()
            found = []
            for f in files:
                fs, p = arrow_fs(f)
                with fs.open_input_file(p) as src:
                    meta = pq.read_metadata(src)
                found.append(((meta.metadata or {}).get(b"geo", b"").decode() or None, meta.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array([g for g, _ in found], pa.string()),
                                              pa.array([n for _, n in found], pa.int64())], names=["file", "geo", "rows"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(path).select("path"))
    return files.mapInArrow(read, "file string, geo string, rows long")


def dataset_geo(spark: SparkSession, path: str) -> DataFrame:
    """One row per geometry column description in use: ``column, srid, xmin, ymin, xmax, ymax, files, rows``. A
    dataset written at once has one; several tell that files of different origin were mixed."""
    footer = F.from_json("geo", "struct<primary_column: string, columns: map<string, struct<"
                                "crs: struct<id: struct<authority: string, code: int>>, bbox: array<double>>>>")
    column = F.element_at("f.columns", F.col("f.primary_column"))
    return (geo_footers(spark, path).withColumn("f", footer)
            .select(F.col("f.primary_column").alias("column"), column["crs"]["id"]["code"].alias("srid"), column["bbox"].alias("b"), "rows")
            .groupBy("column", "srid").agg(
                *[F.min(F.get("b", k)).alias(n) for k, n in enumerate(BOX[:2])],
                *[F.max(F.get("b", k + 2)).alias(n) for k, n in enumerate(BOX[2:])],
                F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")))
