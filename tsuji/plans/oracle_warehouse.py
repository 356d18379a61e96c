"""DuckDB oracles for the warehouse queries."""

from __future__ import annotations

from .oracle import ROADS, VERTS, with_

NORMALIZE = with_(ROADS) + """
SELECT fid, strftime(registration_date, '%Y-%m-%d') AS registration_date, road_type::VARCHAR AS road_type,
  road_classification::VARCHAR AS road_classification, road_status::VARCHAR AS road_status,
  layer_order::VARCHAR AS layer_order, width_category::VARCHAR AS width_category,
  toll_category::VARCHAR AS toll_category, secondary_mesh_code, source_mesh
FROM roads"""

STAGE_TRANSFORM = with_(ROADS) + """
SELECT fid, road_type, road_classification, road_status, width_category, toll_category, registration_date,
  layer_order, source_mesh, secondary_mesh_code, (2 + k % 4)::INTEGER AS npts, 4326 AS srid
FROM roads"""

_CODE_MAX = {"road_type": 5, "road_classification": 6, "road_status": 7, "width_category": 6, "toll_category": 2}
_NOT_NULL = [*_CODE_MAX, "registration_date", "layer_order"]

_FLAWED = """flawed AS (
  SELECT CASE WHEN fid % 47 = 5 THEN fid - fid % 2 ELSE fid END AS fid,
    CASE WHEN fid % 31 = 1 THEN 9 ELSE road_type END AS road_type, road_classification, road_status, width_category,
    CASE WHEN fid % 37 = 2 THEN NULL ELSE toll_category END AS toll_category,
    CASE WHEN fid % 41 = 3 THEN NULL ELSE registration_date END AS registration_date, layer_order, fid % 43 = 4 AS no_line FROM roads)"""

CONSTRAINT_VIOLATIONS = with_(ROADS, _FLAWED) + "\nUNION ALL\n".join(
    [f"SELECT 'not_null:{c}' AS check, count_if({c} IS NULL)::BIGINT AS violations FROM flawed" for c in _NOT_NULL]
    + ["SELECT 'not_null:line', count_if(no_line)::BIGINT FROM flawed"]
    + [f"SELECT 'foreign_key:{c}', count_if({c} IS NOT NULL AND ({c} < 1 OR {c} > {m}))::BIGINT FROM flawed"
       for c, m in _CODE_MAX.items()]
    + ["SELECT 'primary_key:fid', coalesce(sum(n - 1), 0)::BIGINT FROM "
       "(SELECT fid, count(*) n FROM flawed GROUP BY fid HAVING count(*) > 1)"])

NATION_UPSERT = """
SELECT n_nationkey, CASE WHEN n_regionkey <= 2 OR n_regionkey = 4 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey FROM nation"""

CODE_UPSERT = with_(ROADS) + """
SELECT coalesce(n.fid, t.fid) AS fid,
  CASE WHEN n.fid IS NOT NULL THEN n.road_status ELSE t.road_status END AS road_status,
  CASE WHEN n.fid IS NOT NULL THEN n.registration_date ELSE t.registration_date END AS registration_date,
  CASE WHEN n.fid IS NOT NULL THEN n.source_mesh ELSE t.source_mesh END AS source_mesh
FROM (SELECT fid, road_status, registration_date, source_mesh FROM roads WHERE registration_date < DATE '1997-01-01') t
FULL OUTER JOIN (SELECT fid, 5::SMALLINT road_status, registration_date, source_mesh FROM roads
                 WHERE registration_date >= DATE '1996-01-01') n ON t.fid = n.fid"""

MERGE_PARTS = with_(ROADS) + "SELECT source_mesh, count(*) AS n FROM roads GROUP BY source_mesh"

SURROGATE_IDS = with_(ROADS) + "SELECT fid, row_number() OVER (ORDER BY source_mesh, fid) AS id FROM roads"

_NOTE = """concat('survey "é" ', fid % 7)"""

GEOJSON_INGEST = with_(ROADS, VERTS) + f"""
SELECT n.fid, {_NOTE.replace('fid', 'n.fid')} AS note, n.* EXCLUDE (fid), 'LineString' AS geom_type, (v.i + 1)::INTEGER AS npts,
  v.x AS xn, v.y AS yn, 6668 AS srid, 6668 AS tagged_srid
FROM ({NORMALIZE[NORMALIZE.index("SELECT fid, strftime"):]}) n JOIN roads r ON r.fid = n.fid
JOIN verts v ON v.fid = n.fid AND v.i = 1 + r.k % 4"""

# cells on the standard grid: 40 minutes of latitude by one degree of longitude from 100 E
ARCHIVE_SCAN = with_(ROADS, VERTS) + f"""
SELECT n.*, (v.i + 1)::INTEGER AS npts, v.x AS xn, 6668 AS srid
FROM ({NORMALIZE[NORMALIZE.index("SELECT fid, strftime"):]}) n JOIN roads r ON r.fid = n.fid
JOIN verts v ON v.fid = n.fid AND v.i = 1 + r.k % 4
WHERE 100 + n.source_mesh[3:4]::INT <= 138.5 AND 101 + n.source_mesh[3:4]::INT >= 131.0
  AND n.source_mesh[1:2]::INT / 1.5 <= 36.5 AND (n.source_mesh[1:2]::INT + 1) / 1.5 >= 24.5"""

INCREMENTAL_INGEST = with_(ROADS) + f"""
SELECT fid, {_NOTE} AS note, road_type::VARCHAR AS road_type, strftime(registration_date, '%Y-%m-%d') AS registration_date,
  source_mesh, (2 + k % 4)::INTEGER AS npts, 6668 AS srid FROM roads"""

WKB_ROUNDTRIP = with_(ROADS) + "SELECT fid, 9 + 16 * (2 + k % 4)::INTEGER AS nbytes, true AS same FROM roads"

# the archives hold no key: ids follow the attributes, then the geometry; what is the same for rows
# equal in the attributes is compared per id, the geometry by its multiset within them
END_TO_END = with_(ROADS) + """
SELECT row_number() OVER (ORDER BY source_mesh, secondary_mesh_code, road_type, road_classification, road_status, width_category,
    toll_category, registration_date, layer_order) AS fid,
  road_type, road_classification, road_status, width_category, toll_category, registration_date,
  layer_order, source_mesh, secondary_mesh_code, 4326 AS srid
FROM roads"""

ORACLES = {
    "end_to_end": END_TO_END,
    "count_all": with_(ROADS) + "SELECT count(*) AS n FROM roads",
    "incremental_ingest": INCREMENTAL_INGEST,
    "geojson_ingest": GEOJSON_INGEST,
    "archive_scan": ARCHIVE_SCAN,
    "wkb_roundtrip": WKB_ROUNDTRIP,
    "normalize": NORMALIZE,
    "stage_transform": STAGE_TRANSFORM,
    "constraint_violations": CONSTRAINT_VIOLATIONS,
    "code_upsert": CODE_UPSERT,
    "nation_upsert": NATION_UPSERT,
    "merge_parts": MERGE_PARTS,
    "surrogate_ids": SURROGATE_IDS,
}
