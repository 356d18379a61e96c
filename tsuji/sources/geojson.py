"""Zipped GeoJSON archives: reader (S1, S4, S8, G14) and a writer for producing them.

Reading: ``binaryFile`` lists the archives (only the path column is selected, so contents are not
read). A task opens its zips by path and walks the member's JSON text with a bounded buffer, in any
valid layout; it emits the text of each feature as it stands, and Spark parses it in the JVM with a
declared schema. A zip is not splittable, so one archive is one task; the features are dealt out
right after. ``read_features`` writes them once, so that finding unknown attributes, checking the CRS
and every later use read parquet and not the archives again.
"""

from __future__ import annotations

import io
import json
import math
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geom
from ..operators.codes import COLUMN_MAP

RAW = "file_name string, member string, feature_no long, feature string, crs string"
READ_CHARS = 1 << 20            # text read at a time; a longer feature enlarges the buffer
BATCH_CHARS = 8 << 20           # feature text per Arrow batch
ROWS_PER_TASK = 25_000          # features a writing task sorts by archive
# Fixed value: GeoJSON without a "crs" member is WGS 84 longitude/latitude.
GEOJSON_DEFAULT_SRID = 4326
# Names of longitude/latitude systems without an EPSG number (fixed values).
NAMED_SRIDS = {"CRS84": 4326, "CRS83": 4269}
_EPSG = r"EPSG(?:[:/][\w.]*)?[:/](\d+)$"
# Member kinds by preference.
MEMBER_KINDS = (".geojson", ".json")


class ConvertError(RuntimeError):
    """An archive that cannot be read as a feature collection."""


def data_member(names: list[str], archive: str) -> str:
    """The member to read: of the most preferred kind present, the one listed first."""
    by_kind = {k: [n for n in names if n.lower().endswith(k)] for k in MEMBER_KINDS}
    for kind in MEMBER_KINDS:
        for name in by_kind[kind]:
            return name
    raise ConvertError(f"{archive}: none of its {len(names)} members is GeoJSON")


def srid_of_name(name: str | None) -> int:
    """EPSG code of a CRS name: 4326 without a name, -1 for a name of another kind."""
    if not name:
        return GEOJSON_DEFAULT_SRID
    m = re.search(_EPSG, name)
    return int(m[1]) if m else NAMED_SRIDS.get(re.split("[:/]", name)[-1], -1)


def srid_column(name: Column) -> Column:
    """``srid_of_name`` as a column expression."""
    out = F.lit(-1)
    for tail, srid in NAMED_SRIDS.items():
        out = F.when(F.element_at(F.split(name, "[:/]"), -1) == tail, F.lit(srid)).otherwise(out)
    code = F.regexp_extract(name, _EPSG, 1)
    return F.when(name.isNull() | (name == ""), F.lit(GEOJSON_DEFAULT_SRID)).when(code != "", code.try_cast("int")).otherwise(out)


class _Text:
    """JSON text of a stream behind a buffer that is refilled as values are taken from its front."""

    _blank = re.compile(r"[ \t\r\n]*")
    _value = json.JSONDecoder(strict=False).raw_decode

    def __init__(self, stream):
        self.stream, self.buffer, self.at, self.ended = stream, "", 0, False

    def _more(self) -> bool:
        rest = self.buffer[self.at:]
        part = self.stream.read(max(READ_CHARS, len(rest)))     # a long value doubles the buffer
        self.ended = not part
        self.buffer, self.at = rest + part, 0
        return bool(part)

    def mark(self) -> str:
        """The next character that is not blank, empty at the end."""
        while True:
            self.at = self._blank.match(self.buffer, self.at).end()
            if self.at < len(self.buffer):
                return self.buffer[self.at]
            if not self._more():
                return ""

    def take(self, wanted: str) -> None:
        found = self.mark()
        if found != wanted or not found:
            raise ConvertError(f"expected {wanted!r}, found {found!r}")
        self.at += 1

    def value(self) -> tuple[object, str]:
        """(parsed, text) of the next value."""
        self.mark()
        while True:
            try:
                found, end = self._value(self.buffer, self.at)
                if end < len(self.buffer) or self.ended:        # a number could go on
                    text = self.buffer[self.at:end]
                    self.at = end
                    return found, text
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self._more()


def _members(text: _Text) -> Iterator[str]:
    """Keys of the object that begins here; the caller takes each key's value."""
    text.take("{")
    if text.mark() == "}":
        text.at += 1
        return
    while True:
        key, _ = text.value()
        text.take(":")
        yield key
        if text.mark() == "}":
            text.at += 1
            return
        text.take(",")


def _elements(text: _Text) -> Iterator[str]:
    """Texts of the elements of the array that begins here."""
    text.take("[")
    if text.mark() == "]":
        text.at += 1
        return
    while True:
        yield text.value()[1]
        if text.mark() == "]":
            text.at += 1
            return
        text.take(",")


def _crs_name(value) -> str | None:
    return ((value or {}).get("properties") or {}).get("name")


def iter_features(open_member) -> Iterator[tuple[str, str | None]]:
    """(feature text, CRS name) of a FeatureCollection in any layout. ``open_member()`` opens its
    text; a ``crs`` that follows the features is looked up by a walk of its own first."""
    def walk(only_crs: bool):
        with open_member() as stream:
            text, crs, known = _Text(stream), None, False
            for key in _members(text):
                if key == "crs":
                    crs, known = _crs_name(text.value()[0]), True
                elif key != "features":
                    text.value()
                elif text.mark() != "[":
                    text.value()                                # "features": null
                elif only_crs:
                    for _ in _elements(text):
                        pass
                else:
                    if not known:
                        crs, known = next(walk(True)), True
                    for feature in _elements(text):
                        yield feature, crs
            if text.mark():
                raise ConvertError("text after the end of the collection")
            if only_crs:
                yield crs
    return walk(False)


def _read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: paths of archives in, one row per feature out."""
    from ..session import arrow_fs

    names = [x.split()[0] for x in RAW.split(", ")]
    rows, size = [], 0

    def batch_of(rows):
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for path in batch.column("path").to_pylist():
            archive = path.rsplit("/", 1)[-1]
            fs, p = arrow_fs(path)
            with fs.open_input_file(p) as src, zipfile.ZipFile(src) as zf:
                member = data_member(zf.namelist(), archive)
                features = iter_features(lambda: io.TextIOWrapper(zf.open(member), encoding="utf-8-sig"))
                for number, (feature, crs) in enumerate(features):
                    rows.append((archive, member, number, feature, crs))
                    size += len(feature)
                    if size >= BATCH_CHARS:
                        yield batch_of(rows)
                        rows, size = [], 0
    if rows:
        yield batch_of(rows)


def _xy(c):
    return F.struct(c[0].alias("x"), c[1].alias("y"))


_FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()),
                                            T.StructField("coordinates", T.StringType())]))])


def parsed(raw: DataFrame, feature: Column | None = None) -> DataFrame:
    """Feature rows with ``properties`` (all attributes as text), ``geom_type``, ``geometry`` (line),
    ``rings`` (polygon), ``multi_rings`` and ``srid``: one parse of the feature's text in the JVM."""
    f = feature if feature is not None else F.from_json("feature", _FEATURE, {"primitivesAsString": "true"})
    rows = raw.withColumn("_f", f)
    kind, coords = F.col("_f.geometry.type"), F.col("_f.geometry.coordinates")
    line = F.transform(F.from_json(coords, "array<array<double>>"), _xy)
    rings = F.transform(F.from_json(coords, "array<array<array<double>>>"), lambda r: F.transform(r, _xy))
    multi = F.transform(F.from_json(coords, "array<array<array<array<double>>>>"),
                        lambda p: F.transform(p, lambda r: F.transform(r, _xy)))
    return rows.select(
        "file_name", "member", "feature_no", F.col("_f.properties").alias("properties"), kind.alias("geom_type"),
        F.when(kind == "LineString", line).alias("geometry"), F.when(kind == "Polygon", rings).alias("rings"),
        F.when(kind == "MultiPolygon", multi).alias("multi_rings"), srid_column(F.col("crs")).alias("srid"))


def _archive_paths(reader, glob: str):
    return reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")


def read_features(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Every feature of every archive below ``root`` (a missing folder is an error), written once."""
    from ..session import scratch_path

    files = _archive_paths(spark.read.format("binaryFile"), glob).load(root).select("path")
    path = scratch_path(spark, "features")
    # one file per task and archive: the hint deals the rows of a large archive out before parsing
    parsed(files.mapInArrow(_read_archives, RAW).repartition("file_name", "feature_no")).write.parquet(path)
    return spark.read.parquet(path)


def with_attributes(feats: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """Attributes as text columns in place of ``properties``: the given ones, or ``None`` for the
    delivery's known ones followed by every other attribute that occurs, by name."""
    if attributes is None:
        found = feats.select(F.explode(F.map_keys("properties")).alias("k")).distinct().collect()   # attribute names
        taken = set(feats.columns) | set(COLUMN_MAP)
        attributes = [*COLUMN_MAP, *sorted(r.k for r in found if r.k not in taken)]
    value = lambda k: F.element_at("properties", F.lit(k)).alias(k)
    rest = ["geom_type", "geometry", "rings", "multi_rings", "srid"]
    return feats.select("file_name", "member", "feature_no", *[value(k) for k in attributes], "properties", *rest)


def tagged(feats: DataFrame) -> DataFrame:
    """The geometry columns carry the SRID in their metadata when all features share one."""
    srids = [r[0] for r in feats.select("srid").distinct().limit(2).collect()]
    if len(srids) == 1 and srids[0] > 0:
        for c in ("geometry", "rings", "multi_rings"):
            feats = geom.with_srid(feats, c, srids[0])
    return feats


def read_mesh_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """One row per feature of every archive below ``root``: the delivery's attributes and any other
    attribute as text columns, the geometry with its SRID."""
    return tagged(with_attributes(read_features(spark, root, glob)))


def read_feature_archives(spark: SparkSession, root: str, attributes: list[str], glob: str = "*.zip") -> DataFrame:
    """Like ``read_mesh_archives`` for any feature type, with the given text ``attributes`` only."""
    return tagged(with_attributes(read_features(spark, root, glob), attributes))


# ------------------------------------------------------------------ writer (fixtures, exports)
def _geometry_json(rec: dict):
    if "rings" in rec:
        rings = rec.pop("rings")
        return None if rings is None else {"type": "Polygon",
                                           "coordinates": [[[p["x"], p["y"]] for p in r] for r in rings]}
    line = rec.pop("geometry")
    return None if line is None else {"type": "LineString", "coordinates": [[p["x"], p["y"]] for p in line]}


LAYOUTS = ("lines", "leading-comma", "crs-last", "pretty", "compact", "packed-lines")


def collection_text(head: dict, crs: dict | None, features: list[dict], layout: str) -> str:
    """A FeatureCollection in one of the layouts that GeoJSON writers produce."""
    dump = lambda v, **kw: json.dumps(v, ensure_ascii=False, **kw)
    first = {**head, **({"crs": crs} if crs else {})}
    if layout == "pretty":
        return dump({**first, "features": features}, indent=2)
    if layout == "compact":                            # one line, the CRS behind the features
        return dump({**head, "features": features, **({"crs": crs} if crs else {})}, separators=(",", ":"))
    tail = "]\n}\n"
    if layout == "crs-last":
        first, tail = head, "],\n" + f'"crs":\n{dump(crs, indent=1)}\n}}\n' if crs else tail
    texts = [dump(f) for f in features]
    if layout == "leading-comma":
        body = "\n, ".join(texts)
    elif layout == "packed-lines":                     # several features on a line
        body = ",\n".join(", ".join(texts[i:i + 3]) for i in range(0, len(texts), 3))
    else:
        body = ",\n".join(texts)
    return dump(first)[:-1] + ',\n"features": [\n' + body + "\n" + tail


def _archive_writer(root: str, mesh_col: str, chunk_col: str, prefix: str = "N13-24", crs_names: tuple[str, ...] = (),
                    layouts: tuple[str, ...] = LAYOUTS[:1]):
    def write(pdf):
        import pandas as pd

        from ..session import arrow_fs

        mesh = str(pdf[mesh_col].iloc[0])
        chunk = int(pdf[chunk_col].iloc[0])
        name = f"{prefix}_{mesh}_GEOJSON_{chunk:04d}.zip"
        feats = []
        for rec in pdf.drop(columns=[mesh_col, chunk_col]).to_dict("records"):
            geometry = _geometry_json(rec)
            props = {k: (None if v is None or (isinstance(v, float) and v != v) else v) for k, v in rec.items()}
            feats.append({"type": "Feature", "properties": props, "geometry": geometry})
        crs = {"type": "name", "properties": {"name": crs_names[chunk % len(crs_names)]}} if crs_names else None
        text = collection_text({"type": "FeatureCollection", "name": name[:-4]}, crs, feats, layouts[chunk % len(layouts)])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(f"KS-META-{mesh}.xml", "<meta/>")
            zf.writestr(name[:-4] + ".geojson", text)
        fs, base = arrow_fs(root)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"archive": [name], "features": [len(feats)]})
    return write


def write_mesh_archives(df: DataFrame, root: str, mesh_col: str = "mesh", features_per_archive: int = 50_000,
                        key: str = "fid", prefix: str = "N13-24", crs: int = 6668, keep_key: bool = True,
                        crs_names: tuple[str, ...] | None = None, layouts: tuple[str, ...] = LAYOUTS[:1]) -> DataFrame:
    """Write ``df`` (text attributes + ``geometry`` line) as zipped GeoJSON archives.

    Each mesh is split into ceil(rows / features_per_archive) archives by a hash of ``key``, so the
    group a task holds stays near ``features_per_archive`` even for a mesh with a third of all rows
    (the per-mesh counts are one small aggregate, a row per mesh). The counts are broadcast: a join by
    mesh would leave all archives of a mesh, and the sort of their rows, to one task. Archives are dealt
    to as many tasks as keep a task near ``ROWS_PER_TASK`` rows. They take turns with the given
    layouts and CRS names. Returns (archive, features).
    """
    counts = df.groupBy(mesh_col).agg(F.count(F.lit(1)).alias("_n")).select(
        mesh_col, F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(features_per_archive))).alias("_k"))
    chunked = df.join(F.broadcast(counts), mesh_col).withColumn("_chunk", F.pmod(F.xxhash64(key), F.col("_k")))
    chunked = chunked.drop("_k", *([] if keep_key else [key]))
    tasks = math.ceil(df.count() / max(features_per_archive, ROWS_PER_TASK)) or 1
    names = crs_names if crs_names is not None else (f"urn:ogc:def:crs:EPSG::{crs}",)
    return chunked.repartition(tasks, mesh_col, "_chunk").groupBy(mesh_col, "_chunk").applyInPandas(
        _archive_writer(root, mesh_col, "_chunk", prefix, names, layouts), "archive string, features long")


# ------------------------------------------------------------------ unzipped GeoJSON (JVM reader)
_FC_SCHEMA = T.StructType([
    T.StructField("crs", T.StructType([T.StructField("properties", T.StructType([
        T.StructField("name", T.StringType())]))])),
    T.StructField("features", T.ArrayType(_FEATURE)),
])


def read_geojson_files(spark: SparkSession, root: str, glob: str = "*.geojson", attributes: list[str] | None = None) -> DataFrame:
    """Already-unzipped FeatureCollections through Spark's JSON reader (multi-line, declared schema),
    one row per feature, same columns as ``read_mesh_archives``. A file is one record (not
    splittable), so the features are dealt out right after the explode."""
    fc = _archive_paths(spark.read.schema(_FC_SCHEMA).option("multiLine", "true").option("primitivesAsString", "true"), glob).json(root)
    feats = fc.select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file_name"), F.lit(None).cast("string").alias("member"),
                      F.col("crs.properties.name").alias("crs"), F.posexplode("features").alias("feature_no", "f"))
    feats = feats.withColumn("feature_no", F.col("feature_no").cast("long")).repartition("file_name", "feature_no")
    return with_attributes(parsed(feats, F.col("f")), list(COLUMN_MAP) if attributes is None else attributes)
