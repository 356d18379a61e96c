"""Independent DuckDB SQL for every registered query (no spatial extension: arithmetic only).

Each query starts from the driver's views (orders, nation, region, events, pages) and rebuilds
the road / admin / log fixtures with the same integer arithmetic, then answers the question in
plain SQL (vertex rows + self joins instead of array functions wherever possible), so it is a
second, differently shaped implementation rather than a transcription of the Spark plan.
"""

from __future__ import annotations

from ..functions.geodesy import MEAN_RADIUS_M, SPHERE_DISTANCE_RADIUS_M
from ..operators.codes import code_table_sql

ROADS = """roads AS (
  SELECT fid, (1+fid%5)::smallint road_type, (1+ck%6)::smallint road_classification,
    (1+(fid//7)%7)::smallint road_status, (1+(fid//3)%6)::smallint width_category,
    (1+ck%2)::smallint toll_category, od::date registration_date,
    (fid%3-1)::smallint layer_order, mesh source_mesh,
    concat(mesh, lpad((fid%100)::varchar,2,'0')) secondary_mesh_code, k
  FROM (SELECT o_orderkey fid, o_custkey ck, o_orderdate od,
    o_orderkey - CASE WHEN o_orderkey%50=1 THEN 1 ELSE 0 END k,
    ['3622','3631','3724','5339'][1+o_custkey%4] mesh FROM orders))"""

VERTS = """verts AS (
  SELECT fid, i, ((139000000+(k*7919)%1000000+i*20*(100+k%700))/1e6)::double x,
    ((35000000+(k*6007)%1000000+i*i*20*(50+k%300))/1e6)::double y
  FROM (SELECT fid, k, unnest(range(0, 2+k%4)) i FROM roads))"""

SEGS = """segs AS (
  SELECT a.fid, a.i, a.x x1, a.y y1, b.x x2, b.y y2
  FROM verts a JOIN verts b ON a.fid = b.fid AND b.i = a.i + 1)"""

# one list of points per line, in vertex order
LINES = """lines AS (
  SELECT fid, list({'x': x, 'y': y} ORDER BY i) pts, count(*) n FROM verts GROUP BY fid)"""

ADMIN = """admin AS (
  SELECT n_nationkey gid, concat((10+n_regionkey)::varchar, lpad(n_nationkey::varchar,3,'0')) admin_code,
    r_name pref_name, n_name city_name,
    139+(n_nationkey%5)*0.2::double x0, 35+(n_nationkey//5)*0.2::double y0, n_nationkey%6=0 has_hole
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def hav(x1: str, y1: str, x2: str, y2: str, r: float = MEAN_RADIUS_M) -> str:
    h = (f"pow(sin((radians({y2})-radians({y1}))/2),2) + cos(radians({y1}))*cos(radians({y2}))"
         f"*pow(sin((radians({x2})-radians({x1}))/2),2)")
    return f"({2.0 * r!r}*asin(sqrt(CASE WHEN {h} > 1.0 THEN 1.0 ELSE {h} END)))"


SEG_LEN = hav("x1", "y1", "x2", "y2")

def _spheroid_len(iterations: int = 5) -> tuple[str, ...]:
    """CTEs up to ``len (fid, len_m)``: spheroid length per road, Vincenty inverse with a fixed iteration scheme."""
    from ..functions.geodesy import WGS84_A as a, WGS84_F as f
    b = (1 - f) * a
    base = f"""v0 AS MATERIALIZED (
  SELECT fid, x1, y1, x2, y2, L, sU1, cU1, sU2, cU2, L AS lam FROM (
    SELECT fid, x1, y1, x2, y2, radians(x2) - radians(x1) AS L,
      sin(atan({1 - f!r} * tan(radians(y1)))) sU1, cos(atan({1 - f!r} * tan(radians(y1)))) cU1,
      sin(atan({1 - f!r} * tan(radians(y2)))) sU2, cos(atan({1 - f!r} * tan(radians(y2)))) cU2
    FROM segs))"""

    def st(src: str, dst: str) -> str:
        return f"""{dst} AS MATERIALIZED (
  SELECT *, atan2(ss, cs) sig, CASE WHEN ss = 0 THEN 0.0 ELSE cU1 * cU2 * sin(lam) / ss END sa FROM (
    SELECT fid, x1, y1, x2, y2, L, sU1, cU1, sU2, cU2, lam,
      sqrt(pow(cU2 * sin(lam), 2) + pow(cU1 * sU2 - sU1 * cU2 * cos(lam), 2)) ss,
      sU1 * sU2 + cU1 * cU2 * cos(lam) cs FROM {src}))"""

    def dv(src: str, dst: str) -> str:
        return f"""{dst} AS MATERIALIZED (
  SELECT *, CASE WHEN c2a = 0 THEN 0.0 ELSE cs - 2 * sU1 * sU2 / c2a END c2sm FROM (
    SELECT *, 1 - sa * sa c2a FROM {src}))"""

    def step(src: str, dst: str) -> str:
        return f"""{dst} AS MATERIALIZED (
  SELECT fid, x1, y1, x2, y2, L, sU1, cU1, sU2, cU2,
    L + (1 - C) * {f!r} * sa * (sig + C * ss * (c2sm + C * cs * (-1 + 2 * c2sm * c2sm))) AS lam FROM (
    SELECT *, {f / 16!r} * c2a * (4 + {f!r} * (4 - 3 * c2a)) C FROM {src}))"""

    ctes = [base, st("v0", "s0")]
    for k in range(iterations - 1):
        ctes.append(dv(f"s{k}", f"d{k}"))
        ctes.append(step(f"d{k}", f"v{k + 1}"))
        ctes.append(st(f"v{k + 1}", f"s{k + 1}"))
    ctes.append(dv(f"s{iterations - 1}", "fin"))         # distance from the last iteration's state
    k2 = (a * a - b * b) / (b * b)
    return (*ctes, f"""dist AS MATERIALIZED (
  SELECT fid, CASE WHEN x1 = x2 AND y1 = y2 THEN 0.0 ELSE {b!r} * A * (sig - dsig) END d FROM (
    SELECT *, B * ss * (c2sm + B / 4 * (cs * (-1 + 2 * c2sm * c2sm) - B / 6 * c2sm * (-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm))) dsig
    FROM (SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) A,
                  u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) B
          FROM (SELECT *, c2a * {k2!r} u2 FROM fin))))""", "len AS (SELECT fid, sum(d) len_m FROM dist GROUP BY fid)")


SPHEROID_LEN = _spheroid_len()

# places an ocean apart, never nearly antipodal: twelve iterations of the classic scheme, whose series is
# exact to a few tenths of a millimetre
GEODESIC_PAIRS = with_("""segs AS (
  SELECT c_custkey fid, (c_custkey * 7919 % 3600) / 10::double - 180 x1, (c_custkey * 6007 % 1201) / 10::double - 60 y1,
    (c_custkey * 7919 % 3600) / 10::double - 180 + CASE c_custkey % 10 WHEN 3 THEN 0 ELSE (c_custkey * 104729 % 1000) / 10::double END x2,
    CASE c_custkey % 10 WHEN 7 THEN (c_custkey * 6007 % 1201) / 10::double - 60 ELSE (c_custkey * 3571 % 1201) / 10::double - 60 END y2
  FROM customer)""", *_spheroid_len(12)) + "SELECT fid, round(len_m, 0) AS metres FROM len"

LENGTH_BY_TYPE = with_(ROADS, VERTS, SEGS, f"len AS (SELECT fid, sum({SEG_LEN}) len_m FROM segs GROUP BY fid)") + f"""
SELECT rt.label AS road_type, round(sum(len.len_m), 1) AS total_length_m
FROM roads r JOIN len ON r.fid = len.fid JOIN {code_table_sql('road_type')} rt ON r.road_type = rt.code
GROUP BY rt.label ORDER BY total_length_m DESC"""

COUNT_BY_TYPE = with_(ROADS) + "SELECT road_type, count(*) AS n FROM roads GROUP BY road_type ORDER BY road_type"

RANK_IN_MESH = with_(ROADS, VERTS, SEGS, *SPHEROID_LEN, f"""agg AS (
  SELECT r.source_mesh, rt.label road_type_label, count(*) n, sum(len.len_m) total
  FROM roads r JOIN len ON r.fid = len.fid JOIN {code_table_sql('road_type')} rt ON r.road_type = rt.code
  GROUP BY r.source_mesh, rt.label)""") + """
SELECT source_mesh, road_type_label, n, round(total, 1) AS total_len_m,
  CAST(rank() OVER (PARTITION BY source_mesh ORDER BY total DESC) AS BIGINT) AS len_rank
FROM agg ORDER BY source_mesh, len_rank"""

CLASS_SHARE = with_(ROADS, VERTS, SEGS, *SPHEROID_LEN, f"""agg AS (
  SELECT rc.label road_class_label, count(*) n, sum(len.len_m) total
  FROM roads r JOIN len ON r.fid = len.fid JOIN {code_table_sql('road_classification')} rc
    ON r.road_classification = rc.code GROUP BY rc.label)""") + """
SELECT road_class_label, n, round(total, 1) AS total_len_m,
  round(100.0::double * total / sum(total) OVER (), 1) AS len_pct,
  round(100.0::double * n / sum(n) OVER (), 1) AS n_pct
FROM agg ORDER BY total_len_m DESC"""

WIDTH_CUMULATIVE = with_(ROADS, VERTS, SEGS, *SPHEROID_LEN, f"""agg AS (
  SELECT r.source_mesh, wc.code width_code, wc.label width_label, count(*) n, sum(len.len_m) total
  FROM roads r JOIN len ON r.fid = len.fid JOIN {code_table_sql('width_category')} wc ON r.width_category = wc.code
  GROUP BY r.source_mesh, wc.code, wc.label)""") + """
SELECT source_mesh, width_label, n, round(total, 1) AS total_len_m,
  round(sum(total) OVER (PARTITION BY source_mesh ORDER BY width_code), 1) AS cum_len_m
FROM agg ORDER BY source_mesh, width_code"""

# vertex form: coordinates flipped to (lat, lon), distance reads x as latitude
LENGTH_BY_TYPE_VERTICES = with_(ROADS, VERTS, """fl AS (SELECT fid, i, y AS x, x AS y FROM verts)""", """sg AS (
  SELECT a.fid, lead(a.x) OVER w AS nx, lead(a.y) OVER w AS ny, a.x, a.y FROM fl a
  WINDOW w AS (PARTITION BY a.fid ORDER BY a.i))""") + f"""
SELECT r.road_type, round(sum({hav('sg.y', 'sg.x', 'sg.ny', 'sg.nx', SPHERE_DISTANCE_RADIUS_M)}), 1) AS total_length_m
FROM sg JOIN roads r ON r.fid = sg.fid WHERE sg.nx IS NOT NULL GROUP BY r.road_type ORDER BY total_length_m DESC"""


X0, Y0, X1, Y1 = (f"{v!r}::DOUBLE" for v in (139.75, 35.66, 139.79, 35.70))


def _side(cx: str, cy: str) -> str:
    return f"((x2-x1)*({cy}-y1) - (y2-y1)*({cx}-x1))"


_CORNERS = [(X0, Y0), (X1, Y0), (X1, Y1), (X0, Y1)]
SEG_HITS = (f"(least(x1,x2) <= {X1} AND greatest(x1,x2) >= {X0} AND least(y1,y2) <= {Y1} AND greatest(y1,y2) >= {Y0}"
            f" AND NOT ({' AND '.join(_side(cx, cy) + ' > 0' for cx, cy in _CORNERS)})"
            f" AND NOT ({' AND '.join(_side(cx, cy) + ' < 0' for cx, cy in _CORNERS)}))")

HITS = f"hits AS (SELECT DISTINCT fid FROM segs WHERE {SEG_HITS})"
BB = "bb AS (SELECT fid, min(x) xmin, min(y) ymin, max(x) xmax, max(y) ymax FROM verts GROUP BY fid)"

BBOX_OVERLAP = with_(ROADS, VERTS, BB) + f"""
SELECT fid, xmin, ymin, xmax, ymax FROM bb
WHERE xmin <= {X1} AND xmax >= {X0} AND ymin <= {Y1} AND ymax >= {Y0}"""

COVERING_CANDIDATES = with_(ROADS, VERTS, BB) + f"""
SELECT fid FROM bb WHERE xmin <= {X1} AND xmax >= {X0} AND ymin <= {Y1} AND ymax >= {Y0}"""

BBOX_INTERSECTS = with_(ROADS, VERTS, SEGS, HITS) + f"""
SELECT count(DISTINCT fid) AS cnt, round(sum({SEG_LEN}), 1) AS total_length_m
FROM segs WHERE fid IN (SELECT fid FROM hits)"""

BBOX_INTERSECTS_VERTICES = with_(ROADS, VERTS, SEGS, HITS) + f"""
SELECT count(DISTINCT fid) AS cnt,
  round(sum({hav('x1', 'y1', 'x2', 'y2', SPHERE_DISTANCE_RADIUS_M)}), 1) AS total_length_m
FROM segs WHERE fid IN (SELECT fid FROM hits)"""

BBOX_LAYOUT_READ = with_(ROADS, VERTS, SEGS, HITS) + """
SELECT r.fid, r.source_mesh FROM roads r JOIN hits h ON r.fid = h.fid"""

_HSTEP = """lambda a, i: {
  'x': CASE WHEN ((a.y >> i) & 1) = 0 THEN CASE WHEN ((a.x >> i) & 1) = 1 THEN 65535 - a.y ELSE a.y END ELSE a.x END,
  'y': CASE WHEN ((a.y >> i) & 1) = 0 THEN CASE WHEN ((a.x >> i) & 1) = 1 THEN 65535 - a.x ELSE a.x END ELSE a.y END,
  'd': a.d + (xor(3 * ((a.x >> i) & 1), (a.y >> i) & 1) << (2 * i))}"""

HILBERT_CELL = with_(ROADS, VERTS, BB, "tb AS (SELECT min(xmin) mnx, min(ymin) mny, max(xmax) mxx, max(ymax) mxy FROM bb)",
                     """hc AS (SELECT fid,
    CASE WHEN mxx - mnx = 0 THEN 0 ELSE least(65535, floor(((xmin + xmax) / 2 - mnx) * 65535 / (mxx - mnx))) END::BIGINT hx,
    CASE WHEN mxy - mny = 0 THEN 0 ELSE least(65535, floor(((ymin + ymax) / 2 - mny) * 65535 / (mxy - mny))) END::BIGINT hy
  FROM bb, tb)""") + f"""
SELECT fid, list_reduce(range(15, -1, -1), {_HSTEP}, {{'x': hx, 'y': hy, 'd': 0::BIGINT}}).d AS hilbert FROM hc"""

TOTAL_BOUNDS = with_(ROADS, VERTS) + """
SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax,
  (SELECT count(*) FROM roads) AS n, 4326 AS srid FROM verts"""

CROSS_MESH_DUPLICATES = with_(ROADS, VERTS, LINES, """shared AS (
  SELECT l.pts FROM lines l JOIN roads r ON r.fid = l.fid GROUP BY l.pts HAVING count(DISTINCT r.source_mesh) > 1)""") + """
SELECT r.fid, r.source_mesh FROM roads r JOIN lines l ON r.fid = l.fid WHERE l.pts IN (SELECT pts FROM shared)"""

# by fid % 23: 1 missing, 2 empty, 3 a repeated point, 4 an infinite coordinate
INVALID_BY_MESH = with_(ROADS) + """
SELECT source_mesh, count(*) AS n, count_if(fid % 23 = 1) AS n_missing, count_if(fid % 23 = 2) AS n_empty,
  count_if(fid % 23 IN (3, 4)) AS n_invalid, count_if(fid % 23 BETWEEN 1 AND 4) AS n_flagged
FROM roads GROUP BY source_mesh"""

POLYGON_VALIDITY = """
SELECT o_orderkey AS fid, ['invalid', 'invalid', 'missing', 'empty', 'ok'][1 + o_orderkey % 5] AS status FROM orders"""

# lines through zeros: one geometry per sign, so the sign must occur in two meshes
DUPLICATES_SIGNED_ZERO = with_(ROADS, "z AS (SELECT fid, source_mesh, fid % 2 neg FROM roads WHERE fid % 23 = 5)") + """
SELECT fid, source_mesh FROM z WHERE neg IN (SELECT neg FROM z GROUP BY neg HAVING count(DISTINCT source_mesh) > 1)"""

# every flawed row; points carry the sign of a zero, which the comparison of numbers does not see
DUPLICATES_FLAWED = with_(ROADS, VERTS, """lines AS (
  SELECT fid, list({'x': x, 'y': y, 'neg': false} ORDER BY i) pts FROM verts GROUP BY fid)""", """flawed AS (
  SELECT r.fid, r.source_mesh, CASE r.fid % 23 WHEN 1 THEN NULL WHEN 2 THEN pts[1:0] WHEN 3 THEN [pts[1], pts[1]]
    WHEN 4 THEN [pts[1], {'x': 'inf'::double, 'y': 35.0::double, 'neg': false}]
    WHEN 5 THEN [{'x': 0::double, 'y': 1::double, 'neg': r.fid % 2 = 1}, {'x': 1::double, 'y': 2::double, 'neg': false}]
    ELSE pts END pts
  FROM roads r JOIN lines l ON r.fid = l.fid)""", """shared AS (
  SELECT pts FROM flawed WHERE pts IS NOT NULL GROUP BY pts HAVING count(DISTINCT source_mesh) > 1)""") + """
SELECT fid, source_mesh FROM flawed WHERE pts IN (SELECT pts FROM shared)"""

# interior point of a line: centroid of segment midpoints weighted by length (in vertex order),
# then the nearest interior vertex (ties -> lowest index), else the nearer endpoint
_CENT = """cent AS (
  SELECT fid, list_reduce(list({'l': sqrt((x2-x1)*(x2-x1) + (y2-y1)*(y2-y1)), 'mx': (x1+x2)/2, 'my': (y1+y2)/2} ORDER BY i),
    lambda a, s: CASE WHEN s.l <> 0 THEN {'len': a.len + s.l, 'sx': a.sx + s.l * s.mx, 'sy': a.sy + s.l * s.my} ELSE a END,
    {'len': 0::DOUBLE, 'sx': 0::DOUBLE, 'sy': 0::DOUBLE}) c
  FROM segs GROUP BY fid)"""
NV = "nv AS (SELECT fid, max(i) last FROM verts GROUP BY fid)"
CAND = """cand AS (
  SELECT v.fid, v.i, v.x, v.y,
    sqrt((v.x - CASE WHEN c.c.len > 0 THEN c.c.sx / c.c.len ELSE f.x END) * (v.x - CASE WHEN c.c.len > 0 THEN c.c.sx / c.c.len ELSE f.x END)
       + (v.y - CASE WHEN c.c.len > 0 THEN c.c.sy / c.c.len ELSE f.y END) * (v.y - CASE WHEN c.c.len > 0 THEN c.c.sy / c.c.len ELSE f.y END)) d
  FROM verts v JOIN nv ON v.fid = nv.fid JOIN cent c ON v.fid = c.fid JOIN verts f ON f.fid = v.fid AND f.i = 0
  WHERE (nv.last >= 2 AND v.i > 0 AND v.i < nv.last) OR (nv.last < 2))"""
PTS = """pts AS (
  SELECT fid, x AS px, y AS py FROM (
    SELECT fid, x, y, row_number() OVER (PARTITION BY fid ORDER BY d, i) rn FROM cand) WHERE rn = 1)"""

POINT_ON_LINE = with_(ROADS, VERTS, SEGS, _CENT, NV, CAND, PTS) + "SELECT fid, px, py FROM pts"
POINT_ON_LONG_LINE = POINT_ON_LINE.replace("range(0, 2+k%4)", "range(0, 9+k%8)")

# admin cells hold the point strictly inside the shell and outside the closed hole
MATCH = """m AS (
  SELECT p.fid, a.admin_code, left(a.admin_code, 2) pref_code FROM pts p JOIN admin a
    ON p.px > a.x0 AND p.px < a.x0 + 0.2 AND p.py > a.y0 AND p.py < a.y0 + 0.2
   AND NOT (a.has_hole AND p.px BETWEEN a.x0 + 0.075 AND a.x0 + 0.125 AND p.py BETWEEN a.y0 + 0.075 AND a.y0 + 0.125))"""
_M = (ROADS, VERTS, SEGS, _CENT, NV, CAND, PTS, ADMIN, MATCH)
PART = "CASE WHEN pref_code IN ('11','12','13','14') THEN pref_code ELSE 'default' END"

ADMIN_LOAD = with_(ADMIN) + """
SELECT row_number() OVER (ORDER BY admin_code) AS gid, admin_code, pref_name, city_name,
  1 AS n_polygons, CASE WHEN has_hole THEN 2 ELSE 1 END AS n_rings FROM admin"""

PREF_JOIN = with_(*_M) + "SELECT fid, admin_code, pref_code FROM m"

PREF_UNMATCHED = with_(*_M) + "SELECT fid FROM roads WHERE fid NOT IN (SELECT fid FROM m)"

PARTITION_COUNTS = with_(*_M) + f"SELECT {PART} AS part, count(*) AS n FROM m GROUP BY 1"

PARTITION_FILTER = with_(*_M, f"mp AS (SELECT *, {PART} part FROM m)") + (
    "SELECT 'pref_code = ''13''' AS probe, count(*) AS n_rows, count(DISTINCT part) AS n_parts FROM mp"
    " WHERE pref_code = '13'\nUNION ALL\n"
    "SELECT 'pref_code IN (''13'',''14'')', count(*), count(DISTINCT part) FROM mp WHERE pref_code IN ('13', '14')"
    "\nUNION ALL\nSELECT 'no filter', count(*), count(DISTINCT part) FROM mp")

PARTITIONS_TOUCHED = f"SELECT probe, n_parts FROM ({PARTITION_FILTER})"

POINT_ACCESSORS = with_(ROADS, VERTS, "nv AS (SELECT fid, max(i) last, count(*) n FROM verts GROUP BY fid)") + """
SELECT nv.fid, nv.n::INTEGER AS npts, a.x AS x2, a.y AS y2, b.x AS xn, b.y AS yn
FROM nv JOIN verts a ON a.fid = nv.fid AND a.i = 1 JOIN verts b ON b.fid = nv.fid AND b.i = nv.last"""

FLIP = with_(ROADS, VERTS, "nv AS (SELECT fid, max(i) last FROM verts GROUP BY fid)") + """
SELECT nv.fid, a.y AS x1, a.x AS y1, b.y AS xn, b.x AS yn
FROM nv JOIN verts a ON a.fid = nv.fid AND a.i = 0 JOIN verts b ON b.fid = nv.fid AND b.i = nv.last"""

WKT_ROUNDTRIP = with_(ROADS, VERTS) + "SELECT fid, count(*)::INTEGER AS npts, true AS same FROM verts GROUP BY fid"


LENGTH_SPHEROID = with_(ROADS, VERTS, SEGS, *SPHEROID_LEN) + f"""
SELECT rt.label AS road_type, round(sum(len.len_m), 1) AS total_length_m
FROM len JOIN roads r ON r.fid = len.fid JOIN {code_table_sql('road_type')} rt ON r.road_type = rt.code
GROUP BY rt.label ORDER BY total_length_m DESC"""

ORACLES: dict[str, str] = {
    "admin_load": ADMIN_LOAD,
    "pref_join": PREF_JOIN,
    "pref_unmatched": PREF_UNMATCHED,
    "partition_counts": PARTITION_COUNTS,
    "partition_filter": PARTITION_FILTER,
    "bbox_overlap": BBOX_OVERLAP,
    "covering_candidates": COVERING_CANDIDATES,
    "bbox_intersects": BBOX_INTERSECTS,
    "bbox_intersects_vertices": BBOX_INTERSECTS_VERTICES,
    "bbox_layout_read": BBOX_LAYOUT_READ,
    "indexed_bbox_read": BBOX_LAYOUT_READ,
    "hilbert_cell": HILBERT_CELL,
    "total_bounds": TOTAL_BOUNDS,
    "cross_mesh_duplicates": CROSS_MESH_DUPLICATES,
    "streaming_duplicates": CROSS_MESH_DUPLICATES,
    "invalid_by_mesh": INVALID_BY_MESH,
    "point_on_line": POINT_ON_LINE,
    "point_on_long_line": POINT_ON_LONG_LINE,
    "polygon_validity": POLYGON_VALIDITY,
    "duplicates_signed_zero": DUPLICATES_SIGNED_ZERO,
    "duplicates_flawed": DUPLICATES_FLAWED,
    "partitions_touched": PARTITIONS_TOUCHED,
    "point_accessors": POINT_ACCESSORS,
    "flip": FLIP,
    "wkt_roundtrip": WKT_ROUNDTRIP,
    "length_spheroid": LENGTH_SPHEROID,
    "geodesic_pairs": GEODESIC_PAIRS,
    "length_by_type": LENGTH_BY_TYPE,
    "count_by_type": COUNT_BY_TYPE,
    "rank_in_mesh": RANK_IN_MESH,
    "class_share": CLASS_SHARE,
    "width_cumulative": WIDTH_CUMULATIVE,
    "length_by_type_vertices": LENGTH_BY_TYPE_VERTICES,
}
