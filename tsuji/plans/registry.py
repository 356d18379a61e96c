"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialized
from ..sources import fixtures as fx
from . import analysis as an
from . import enrich as en
from . import flow as fl
from . import geometry as ge
from . import logs as lg
from . import ingest as ig
from . import reports as rp
from . import warehouse as wh

Query = Callable[[SparkSession, str], DataFrame]


def _roads(spark: SparkSession, sf: str) -> DataFrame:
    return fx.roads(spark, sf)


def _partials(spark: SparkSession, sf: str) -> DataFrame:
    """The roads' partial lengths, written once per application; the reports only read this table."""
    return spark.read.parquet(materialized(spark, "road_lengths", (sf,), lambda: an.partial_lengths(_roads(spark, sf))))


QUERIES: dict[str, Query] = {
    "length_by_type": lambda s, d: an.length_by_type(s, _roads(s, d)),
    "count_by_type": lambda s, d: an.count_by_type(_roads(s, d)),
    "rank_in_mesh": lambda s, d: an.rank_in_mesh(s, _partials(s, d)),
    "class_share": lambda s, d: an.class_share(s, _partials(s, d)),
    "width_cumulative": lambda s, d: an.width_cumulative(s, _partials(s, d)),
    "length_by_type_vertices": lambda s, d: an.length_by_type_vertices(_roads(s, d)),
    "geodesic_pairs": an.geodesic_pairs,
    "length_spheroid": lambda s, d: an.length_spheroid_by_type(s, _roads(s, d)),
    "bbox_overlap": ge.bbox_overlap,
    "covering_candidates": ge.covering_candidates,
    "bbox_intersects": ge.bbox_intersects,
    "bbox_intersects_vertices": ge.bbox_intersects_vertices,
    "bbox_layout_read": ge.bbox_layout_read,
    "indexed_bbox_read": ge.indexed_bbox_read,
    "hilbert_cell": ge.hilbert_cell,
    "total_bounds": ge.total_bounds,
    "cross_mesh_duplicates": ge.cross_mesh_duplicates,
    "invalid_by_mesh": ge.invalid_by_mesh,
    "point_on_line": ge.point_on_line,
    "point_on_long_line": ge.point_on_long_line,
    "polygon_validity": ge.polygon_validity,
    "polygon_faults": ge.polygon_faults,
    "duplicates_signed_zero": ge.duplicates_signed_zero,
    "duplicates_flawed": ge.duplicates_flawed,
    "point_accessors": ge.point_accessors,
    "flip": ge.flip,
    "wkt_roundtrip": ge.wkt_roundtrip,
    "admin_load": en.admin_load,
    "pref_join": en.pref_join,
    "pref_unmatched": en.pref_unmatched,
    "partition_counts": en.partition_counts,
    "partition_filter": en.partition_filter,
    "partitions_touched": en.partitions_touched,
    "http_parse": lg.http_parse,
    "transfer_summary": lg.transfer_summary,
    "fetch_worklist": lg.fetch_worklist,
    "normalize": wh.normalize,
    "stage_transform": wh.stage_transform,
    "constraint_violations": wh.constraint_violations,
    "code_upsert": wh.code_upsert,
    "nation_upsert": wh.nation_upsert,
    "merge_parts": wh.merge_parts,
    "surrogate_ids": wh.surrogate_ids,
    "geojson_ingest": ig.geojson_ingest,
    "archive_scan": ig.archive_scan,
    "wkb_roundtrip": ig.wkb_roundtrip,
    "geoparquet_roundtrip": ig.geoparquet_roundtrip,
    "polygon_geoparquet": ig.polygon_geoparquet,
    "streaming_duplicates": ig.streaming_duplicates,
    "incremental_ingest": ig.incremental_ingest,
    "scan_cost": rp.scan_cost_report,
    "end_to_end": fl.end_to_end,
    "count_all": fl.count_all,
}
