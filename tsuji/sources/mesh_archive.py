"""Zipped GeoJSON archives as a Spark data source (S1, S8): ``spark.read.format("mesh_archives")``.

A partition is one GeoJSON member of one archive. The options ``meshes`` and ``box`` are decided on an archive's
name, by its mesh code and that mesh's cell on the standard grid: archives they rule out are never opened,
neither when the members are listed nor to be read. The features come as text, a batch at a time, and are
parsed in the JVM.

They are options of the scan and not pushed filters on purpose. Spark 4.1 keeps one reader per loaded relation:
where the same relation occurs twice in a query with different filters, or once filtered and later whole, the
filters pushed last decide all of them, and rows are lost (``tests/test_indexes.py`` holds the scan to this).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import MESH_RE
from ..session import arrow_fs, ship_package
from . import geojson

FORMAT = "mesh_archives"
CELL = ("cell_xmin", "cell_ymin", "cell_xmax", "cell_ymax")
COLUMNS = geojson.RAW + ", source_mesh string, " + ", ".join(f"{c} double" for c in CELL)
LISTING_THREADS = 32


def cell_of(mesh: str | None) -> tuple[float, float, float, float] | None:
    """(xmin, ymin, xmax, ymax) of a mesh code of four digits (40 minutes by one degree) or six (an eighth of
    that each way); None for any other code."""
    if mesh is None or not re.fullmatch(r"\d{4}(?:[0-7]{2})?", mesh):
        return None
    row, column = int(mesh[:2]) * 8, (100 + int(mesh[2:4])) * 8
    if len(mesh) == 4:
        return column / 8, row / 12, (column + 8) / 8, (row + 8) / 12
    row, column = row + int(mesh[4]), column + int(mesh[5])
    return column / 8, row / 12, (column + 1) / 8, (row + 1) / 12


def facts(path: str) -> dict:
    """What an archive's name tells of all its features."""
    name = path.rsplit("/", 1)[-1]
    found = re.search(MESH_RE, name)
    mesh = found[1] if found else None
    return {"file_name": name, "source_mesh": mesh, **dict(zip(CELL, cell_of(mesh) or (None,) * 4))}


@dataclass
class Member(InputPartition):
    """One GeoJSON member of an archive."""

    path: str
    member: str


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.glob = options["path"], options.get("glob", "*.zip")
        self.meshes = set(options["meshes"].split(",")) if "meshes" in options else None
        self.box = [float(v) for v in options["box"].split(",")] if "box" in options else None

    def wanted(self, path: str) -> bool:
        """A name without a mesh that is on the grid cannot be ruled out by a box."""
        known = facts(path)
        if not fnmatch(known["file_name"], self.glob) or self.meshes is not None and known["source_mesh"] not in self.meshes:
            return False
        xmin, ymin, xmax, ymax = (known[c] for c in CELL)
        return self.box is None or xmin is None or (
            xmin <= self.box[2] and xmax >= self.box[0] and ymin <= self.box[3] and ymax >= self.box[1])

    def archives(self) -> list[str]:
        """Paths of the archives wanted, sorted. A missing folder is an error."""
        scheme = self.root.split("://", 1)[0] + "://" if "://" in self.root else ""
        fs, base = arrow_fs(self.root)
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True))
        return sorted(scheme + i.path for i in found if i.is_file and self.wanted(i.path))

    def partitions(self) -> list[Member]:
        """The members of the archives left: only their tables of contents are read, many at a time."""
        def members(path: str) -> list[Member]:
            fs, p = arrow_fs(path)
            with fs.open_input_file(p) as src, zipfile.ZipFile(src) as zf:
                names = zf.namelist()
            kind = next((k for k in geojson.MEMBER_KINDS if any(n.lower().endswith(k) for n in names)), None)
            if kind is None:
                raise geojson.ConvertError(f"{path}: none of its {len(names)} members is GeoJSON")
            return [Member(path, n) for n in names if n.lower().endswith(kind)]

        with ThreadPoolExecutor(LISTING_THREADS) as pool:
            return [m for found in pool.map(members, self.archives()) for m in found] or [Member("", "")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        known = facts(partition.path)
        fs, p = arrow_fs(partition.path)
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            number, feature, crs = zip(*rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([known["file_name"]] * n), pa.array([partition.member] * n), pa.array(number, pa.int64()), pa.array(feature, pa.string()),
                 pa.array(crs, pa.string()), pa.array([known["source_mesh"]] * n, pa.string()), *(pa.array([known[c]] * n, pa.float64()) for c in CELL)],
                names=["file_name", "member", "feature_no", "feature", "crs", "source_mesh", *CELL])

        with fs.open_input_file(p) as src, zipfile.ZipFile(src) as zf:
            opened = lambda: io.TextIOWrapper(zf.open(partition.member), encoding="utf-8-sig")
            for number, (feature, crs) in enumerate(geojson.iter_features(opened)):
                rows.append((number, feature, crs))
                size += len(feature)
                if size >= geojson.BATCH_CHARS:
                    yield batch()
                    rows, size = [], 0
            if rows:
                yield batch()


class MeshArchives(DataSource):
    """Options: ``path`` (folder, searched with its subfolders), ``glob`` (archive names), ``meshes`` (codes
    joined by commas) and ``box`` (xmin, ymin, xmax, ymax joined by commas)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def scan_archives(spark: SparkSession, root: str, glob: str = "*.zip", meshes: Sequence[str] | None = None,
                  box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Feature texts of the archives below ``root``, of the given mesh codes and of meshes whose cell meets
    the box only, with what the archive's name tells (``source_mesh``, ``cell_*``)."""
    ship_package(spark)
    spark.dataSource.register(MeshArchives)
    scan = spark.read.format(FORMAT).option("glob", glob)
    if meshes is not None:
        scan = scan.option("meshes", ",".join(meshes))
    if box is not None:
        scan = scan.option("box", ",".join(repr(float(v)) for v in box))
    return scan.load(root)


def features_of(texts: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """Feature rows of ``scan_archives`` rows: as ``geojson.read_mesh_archives`` gives them, with the
    delivery's attributes unless others are named."""
    rows = geojson.parsed(texts)
    return geojson.with_attributes(rows, list(geojson.COLUMN_MAP) if attributes is None else attributes)
