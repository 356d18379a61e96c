"""DuckDB oracles of polygons (validity by every pair of edges and point-in-ring counts) and of GeoParquet."""

from __future__ import annotations

from ..sources.fixtures import SHAPES
from .oracle import ROADS, VERTS, with_

_VERTICES = ", ".join(f"({k}, {p}, {r}, {i}, {x}, {y})" for k, shape in enumerate(SHAPES) for p, polygon in enumerate(shape)
                      for r, ring in enumerate(polygon) for i, (x, y) in enumerate(ring))

PLACED = f"""v AS (
  SELECT c_custkey fid, 100 * p + r rg, p, r, i, (c_custkey % 300 - 150 + x * s)::double x, (c_custkey // 7 % 120 - 60 + y * s)::double y
  FROM (SELECT c_custkey, c_custkey % {len(SHAPES)} kind, [0.125, 0.25, 1, 2][1 + c_custkey // 20 % 4]::double s FROM customer)
  JOIN (VALUES {_VERTICES}) t(kind, p, r, i, x, y) USING (kind))"""


def _side(a: str, b: str, px: str, py: str) -> str:
    return f"(({b}x - {a}x) * ({py} - {a}y) - ({b}y - {a}y) * ({px} - {a}x))"


def _on(e: str, px: str, py: str) -> str:
    """Point on an edge (e = alias of a row ax, ay, zx, zy)."""
    return (f"({_side(e + '.a', e + '.z', px, py)} = 0 AND {px} BETWEEN least({e}.ax, {e}.zx) AND greatest({e}.ax, {e}.zx) "
            f"AND {py} BETWEEN least({e}.ay, {e}.zy) AND greatest({e}.ay, {e}.zy))")


EDGES = """e AS (
  SELECT a.fid, a.rg, a.p, a.r, a.i, a.x ax, a.y ay, b.x zx, b.y zy
  FROM v a JOIN v b ON a.fid = b.fid AND a.rg = b.rg AND b.i = a.i + 1)"""

RING = """ring AS (
  SELECT fid, rg, any_value(p) p, any_value(r) r, count(*) n, count(DISTINCT (x, y)) points,
    arg_min(x, i) = arg_max(x, i) AND arg_min(y, i) = arg_max(y, i) closed FROM v GROUP BY fid, rg)"""

PAIR = f"""pair AS (
  SELECT m.fid, m.rg = o.rg same, abs(m.i - o.i) = 1 OR abs(m.i - o.i) = g.n - 2 beside,
    {_side('m.a', 'm.z', 'o.ax', 'o.ay')} * {_side('m.a', 'm.z', 'o.zx', 'o.zy')} < 0
      AND {_side('o.a', 'o.z', 'm.ax', 'm.ay')} * {_side('o.a', 'o.z', 'm.zx', 'm.zy')} < 0 crossed,
    {_on('m', 'o.ax', 'o.ay')} OR {_on('m', 'o.zx', 'o.zy')} OR {_on('o', 'm.ax', 'm.ay')} OR {_on('o', 'm.zx', 'm.zy')} met,
    {_side('m.a', 'm.z', 'o.ax', 'o.ay')} = 0 AND {_side('m.a', 'm.z', 'o.zx', 'o.zy')} = 0
      AND (least(greatest(m.ax, m.zx), greatest(o.ax, o.zx)) > greatest(least(m.ax, m.zx), least(o.ax, o.zx))
        OR least(greatest(m.ay, m.zy), greatest(o.ay, o.zy)) > greatest(least(m.ay, m.zy), least(o.ay, o.zy))) along
  FROM e m JOIN e o ON m.fid = o.fid AND (m.rg, m.i) < (o.rg, o.i) JOIN ring g ON g.fid = m.fid AND g.rg = m.rg)"""

# edges cut at the vertices of other rings that lie on them; the pieces' middles tell inside from outside
PIECES = f"""cut AS (
  SELECT e.fid, e.rg, e.i, e.ax, e.ay, e.zx, e.zy, w.x, w.y FROM e JOIN v w ON w.fid = e.fid AND {_on('e', 'w.x', 'w.y')} GROUP BY ALL),
mid AS (SELECT fid, rg, (x + nx) / 2 x, (y + ny) / 2 y FROM (
  SELECT *, lead(x) OVER w nx, lead(y) OVER w ny FROM cut
  WINDOW w AS (PARTITION BY fid, rg, i ORDER BY abs(x - ax) + abs(y - ay))) WHERE nx IS NOT NULL)"""

WITHIN = f"""within AS (
  SELECT fid, rg, q, bool_or(c % 2 = 1) some_in, bool_or(c % 2 = 0) some_out FROM (
    SELECT m.fid, m.rg, m.x, m.y, g.rg q, count(*) FILTER ((o.ay > m.y) <> (o.zy > m.y)
        AND (CASE WHEN o.zy > o.ay THEN 1 ELSE -1 END) * {_side('o.a', 'o.z', 'm.x', 'm.y')} > 0) c
    FROM mid m JOIN ring g ON g.fid = m.fid AND g.rg <> m.rg JOIN e o ON o.fid = g.fid AND o.rg = g.rg GROUP BY ALL)
  GROUP BY fid, rg, q)"""

# touching points and rings of a polygon as a graph: a cycle parts the interior
PARTED = f"""meet AS (
  SELECT DISTINCT w.fid, e.p, e.rg, w.x, w.y FROM v w JOIN e ON e.fid = w.fid AND e.p = w.p AND {_on('e', 'w.x', 'w.y')}),
joint AS (SELECT m.* FROM meet m JOIN (
  SELECT fid, p, x, y FROM meet GROUP BY ALL HAVING count(*) > 1) USING (fid, p, x, y)),
reach AS (SELECT DISTINCT fid, p, rg a, rg b FROM joint
  UNION SELECT reach.fid, reach.p, reach.a, k.rg FROM reach JOIN joint j ON j.fid = reach.fid AND j.p = reach.p AND j.rg = reach.b
    JOIN joint k ON k.fid = j.fid AND k.p = j.p AND k.x = j.x AND k.y = j.y),
parted AS (SELECT j.fid FROM (SELECT fid, p, count(*) links, count(DISTINCT rg) + count(DISTINCT (x, y)) nodes FROM joint GROUP BY ALL) j
  JOIN (SELECT fid, p, count(DISTINCT low) pieces FROM (SELECT fid, p, a, min(b) low FROM reach GROUP BY ALL) GROUP BY ALL) c USING (fid, p)
  WHERE links > nodes - pieces)"""

POLYGON_FAULTS = with_(PLACED, EDGES, RING, PAIR, PIECES, WITHIN, PARTED).replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT c_custkey AS fid, CASE
  WHEN c_custkey IN (SELECT fid FROM ring WHERE n < 4 OR NOT closed) THEN 'ring not closed'
  WHEN c_custkey IN (SELECT fid FROM ring WHERE points < 3) THEN 'ring of fewer than three points'
  WHEN c_custkey IN (SELECT fid FROM pair WHERE along) THEN 'edges overlap'
  WHEN c_custkey IN (SELECT fid FROM pair WHERE same AND (crossed OR met AND NOT beside)) THEN 'ring meets itself'
  WHEN c_custkey IN (SELECT fid FROM pair WHERE crossed UNION ALL SELECT fid FROM within WHERE some_in AND some_out) THEN 'rings cross'
  WHEN c_custkey IN (SELECT w.fid FROM within w WHERE rg % 100 = 0 AND q % 100 = 0 AND some_in AND NOT EXISTS (
    FROM within h WHERE h.fid = w.fid AND h.rg = w.rg AND h.q // 100 = w.q // 100 AND h.q % 100 > 0 AND h.some_in)) THEN 'polygon inside another'
  WHEN c_custkey IN (SELECT fid FROM within WHERE rg // 100 = q // 100 AND rg % 100 > 0 AND q % 100 = 0 AND some_out) THEN 'hole outside its shell'
  WHEN c_custkey IN (SELECT fid FROM within WHERE rg // 100 = q // 100 AND rg % 100 > 0 AND q % 100 > 0 AND some_in) THEN 'hole inside a hole'
  WHEN c_custkey IN (SELECT fid FROM parted) THEN 'interior not connected' ELSE 'ok' END AS fault
FROM customer"""

GEOPARQUET = with_(ROADS, VERTS) + """
SELECT source_mesh, count(*) n, count(*) same, count(*) covered, 6668 AS srid, any_value(t.xmin) xmin, any_value(t.ymin) ymin,
  any_value(t.xmax) xmax, any_value(t.ymax) ymax
FROM roads, (SELECT min(x) xmin, min(y) ymin, max(x) xmax, max(y) ymax FROM verts) t GROUP BY source_mesh"""

# 9 bytes of head, 9 of each polygon's, 4 of each ring's, 16 of each vertex
POLYGON_GEOPARQUET = with_(PLACED) + """
SELECT fid, true AS same, (9 + 9 * count(DISTINCT p) + 4 * count(DISTINCT rg) + 16 * count(*))::BIGINT AS nbytes, count(*) AS vertices,
  min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM v GROUP BY fid"""

ORACLES: dict[str, str] = {
    "polygon_faults": POLYGON_FAULTS,
    "geoparquet_roundtrip": GEOPARQUET,
    "polygon_geoparquet": POLYGON_GEOPARQUET,
}
