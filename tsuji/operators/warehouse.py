"""Stage -> typed table: rename, typed projection, checks, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geom
from ..functions.text import mesh_code_from_name
from ..session import publish, version_path
from .codes import CODE_COLUMNS, CODE_TABLES, COLUMN_MAP
from .ids import dense_id

SOURCE_MESH = "source_mesh"


def normalize_roads(df: DataFrame, mesh=None, file_col: str | None = None) -> DataFrame:
    """Rename the delivery attributes to stable names (unknown columns pass through) and tag each
    row with its mesh: a literal ``mesh`` or the code parsed from ``file_col`` (error if absent)."""
    present = {k: v for k, v in COLUMN_MAP.items() if k in df.columns}
    out = df.withColumnsRenamed(present)
    if mesh is not None:
        return out.withColumn(SOURCE_MESH, F.lit(str(mesh)))
    if file_col is None:
        raise ValueError("normalize_roads needs a mesh code or a file-name column")
    return out.withColumn(SOURCE_MESH, mesh_code_from_name(file_col))


def typed_roads(stage: DataFrame, geometry: str = "geometry", out_geometry: str = "line",
                src_srid: int | None = None, dst_srid: int = 4326) -> DataFrame:
    """Typed projection of the stage table: codes -> smallint, timestamp -> date, layer -> smallint,
    geometry moved to ``dst_srid``. Casts run under ANSI rules, so '1.5' -> smallint is an error."""
    srid = src_srid if src_srid is not None else (geom.srid_of(stage, geometry) or 6668)
    cols = []
    if "fid" in stage.columns:
        cols.append(F.col("fid").cast("bigint").alias("fid"))
    cols += [F.col(c).cast("smallint").alias(c) for c in CODE_COLUMNS]
    cols += [F.col("registration_date").cast("date").alias("registration_date"),
             F.col("layer_order").cast("smallint").alias("layer_order"),
             F.col(SOURCE_MESH).cast("string").alias(SOURCE_MESH),
             F.col("secondary_mesh_code").cast("string").alias("secondary_mesh_code"),
             geom.transform_crs(geometry, srid, dst_srid).alias(out_geometry)]
    return geom.with_srid(stage.select(*cols), out_geometry, dst_srid)


def constraint_violations(spark: SparkSession, roads: DataFrame, key: list[str] | None = None,
                          geometry: str = "line") -> DataFrame:
    """(check, violations) for the fact-table rules: NOT NULL columns, foreign keys to the code
    tables and the primary key. Zero everywhere means clean.

    FK and NOT NULL checks are one pass (five broadcast lookups into fixed tables of at most 7 rows
    + one aggregate); the key check is one shuffle on the key with map-side pre-aggregation.
    """
    key = key or ["fid"]
    df = roads
    for c in CODE_COLUMNS:
        codes = spark.createDataFrame([(k,) for k, _ in CODE_TABLES[c]], f"_k_{c} smallint")
        df = df.join(F.broadcast(codes), df[c] == codes[f"_k_{c}"], "left")
    not_null = [*CODE_COLUMNS, "registration_date", "layer_order", geometry]
    aggs = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null]
    aggs += [F.count_if(F.col(c).isNotNull() & F.col(f"_k_{c}").isNull()).alias(f"foreign_key:{c}")
             for c in CODE_COLUMNS]
    row_checks = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in row_checks.columns)
    per_check = row_checks.selectExpr(f"stack({len(row_checks.columns)}, {stack}) AS (check, violations)")
    dup = (roads.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
           .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations"))
           .select(F.lit("primary_key:" + ",".join(key)).alias("check"), "violations"))
    return per_check.unionByName(dup).select("check", F.col("violations").cast("bigint").alias("violations"))


class ConstraintError(RuntimeError):
    pass


STABLE_ORDER = [SOURCE_MESH, "secondary_mesh_code", *CODE_COLUMNS, "registration_date", "layer_order"]


def with_identity(typed: DataFrame, geometry: str = "line", out: str = "fid") -> DataFrame:
    """``out`` = 1, 2, ... as an identity column would give it, in a repeatable order: the
    attributes, then the geometry's text. Rows equal in all of that are interchangeable."""
    order = [c for c in STABLE_ORDER if c in typed.columns]
    tied = typed.withColumn("_text", F.col(geometry).cast("string")).withColumn("_hash", F.xxhash64("_text"))
    return dense_id(tied, [*order, "_hash", "_text"], out=out).select(out, *typed.columns)


def transform(spark: SparkSession, stage: DataFrame, target: str, **kw) -> int:
    """Stage -> typed table below the folder ``target``; returns the number of rows written.

    A stage without ``fid`` (the delivery has none) gets one as an identity column. The rows are
    written to a new folder, checked there in one pass beside the key check, and published by
    ``publish`` only when every check passes: a failed write or check leaves the old table as it was.
    """
    typed = typed_roads(stage, **kw)
    if "fid" not in typed.columns:
        typed = with_identity(typed)
    new = version_path(target)
    typed.write.parquet(new)
    written = spark.read.parquet(new)
    bad = constraint_violations(spark, written).where("violations > 0").collect()   # at most 14 rows
    if bad:
        raise ConstraintError("; ".join(f"{r['check']}={r['violations']}" for r in bad))
    publish(spark, target, new)
    return written.count()                       # answered from the footers


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE``: rows of ``changes`` replace same-key rows of
    ``target``, new keys are added, the rest of ``target`` is kept.

    Written as ``target LEFT ANTI changes`` plus ``changes``: unlike a full outer join (which can
    never be broadcast) the anti join lets AQE broadcast a change batch whose measured size is
    small, so the large target is not shuffled. Write the result to a new path and swap, since
    plain parquet tables have no in-place MERGE.
    """
    kept = target.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.select(*target.columns))
