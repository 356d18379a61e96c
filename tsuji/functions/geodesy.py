"""Geodesic lengths as Column expressions. Coordinates are (x = longitude, y = latitude) in degrees.

All sums run per line inside ``aggregate`` over the vertex pairs, so a length is computed in
the scan stage with no shuffle (the vertex-row form, ``posexplode`` + ``lead``, is kept in
``tsuji.plans.analysis`` as a cross-check).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .geom import _c, segments

# Fixed values.
# Mean earth radius (IUGG R1 of GRS80/WGS84) used for sphere lengths on geography.
MEAN_RADIUS_M = 6371008.7714150598
# Radius of the point-to-point sphere distance function (lat/lon reading variant).
SPHERE_DISTANCE_RADIUS_M = 6371000.0
# WGS 84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
# Vincenty iterations. Each shrinks the error of the longitude about 300 times, so that five are exact to a
# fraction of a millimetre for segments that span no more than LONG_DEGREES; longer ones are solved by
# ``geodesic_distance``.
VINCENTY_ITERATIONS = 5
LONG_DEGREES = 10.0


def haversine(lon1, lat1, lon2, lat2, radius: float = MEAN_RADIUS_M) -> Column:
    """Great-circle distance in metres between two lon/lat points (degrees)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    # clamp rounding overshoot; `least` would skip a null h (a missing successor) and return 1
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.when(h > 1.0, F.lit(1.0)).otherwise(h)))


def length_sphere(line, radius: float = MEAN_RADIUS_M) -> Column:
    """ST_Length(geography, use_spheroid => false): sum of haversine segment lengths."""
    return F.aggregate(segments(line), F.lit(0.0), lambda acc, s: acc + haversine(
        s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"], radius))


def vincenty(lon1, lat1, lon2, lat2, a: float = WGS84_A, f: float = WGS84_F,
             iterations: int = VINCENTY_ITERATIONS) -> Column:
    """Ellipsoidal distance (Vincenty inverse) in metres with a fixed number of iterations.

    The iteration state travels in an ``aggregate`` over ``sequence(1, n)`` so the expression
    stays linear in size. Zero-length pairs give 0; cos^2(alpha) = 0 is guarded. For pairs within LONG_DEGREES;
    ``with_spheroid_length`` takes any.
    """
    b = (1 - f) * a
    L = F.radians(_c(lon2)) - F.radians(_c(lon1))
    U1 = F.atan((1 - f) * F.tan(F.radians(_c(lat1))))
    U2 = F.atan((1 - f) * F.tan(F.radians(_c(lat2))))
    consts = F.struct(F.sin(U1).alias("s1"), F.cos(U1).alias("c1"), F.sin(U2).alias("s2"),
                      F.cos(U2).alias("c2"), L.alias("L"))

    def state(k, lam):
        sU1, cU1, sU2, cU2 = k["s1"], k["c1"], k["s2"], k["c2"]
        sl, cl = F.sin(lam), F.cos(lam)
        sin_sig = F.sqrt(F.pow(cU2 * sl, 2) + F.pow(cU1 * sU2 - sU1 * cU2 * cl, 2))
        cos_sig = sU1 * sU2 + cU1 * cU2 * cl
        return F.struct(lam.alias("lam"), sin_sig.alias("ss"), cos_sig.alias("cs"),
                        F.atan2(sin_sig, cos_sig).alias("sig"),
                        F.when(sin_sig == 0, F.lit(0.0)).otherwise(cU1 * cU2 * sl / sin_sig).alias("sa"))

    def derived(k, st):
        cos2a = 1 - st["sa"] * st["sa"]
        cos2sm = F.when(cos2a == 0, F.lit(0.0)).otherwise(st["cs"] - 2 * k["s1"] * k["s2"] / cos2a)
        return cos2a, cos2sm

    def step(k, st):
        cos2a, cos2sm = derived(k, st)
        C = F.lit(f / 16) * cos2a * (4 + F.lit(f) * (4 - 3 * cos2a))
        lam = k["L"] + (1 - C) * F.lit(f) * st["sa"] * (
            st["sig"] + C * st["ss"] * (cos2sm + C * st["cs"] * (-1 + 2 * cos2sm * cos2sm)))
        return state(k, lam)

    def finish(k, st):
        cos2a, cos2sm = derived(k, st)
        u2 = cos2a * F.lit((a * a - b * b) / (b * b))
        A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
        B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
        ss, cs = st["ss"], st["cs"]
        dsig = B * ss * (cos2sm + B / 4 * (cs * (-1 + 2 * cos2sm * cos2sm)
                                           - B / 6 * cos2sm * (-3 + 4 * ss * ss) * (-3 + 4 * cos2sm * cos2sm)))
        return F.lit(b) * A * (st["sig"] - dsig)

    # constants are evaluated once (initial value); pass 0 evaluates the state at lambda = L,
    # passes 1..n-1 refine lambda; the distance uses the state of the last pass
    empty = F.lit(None).cast("struct<lam:double,ss:double,cs:double,sig:double,sa:double>")
    dist = F.aggregate(
        F.sequence(F.lit(0), F.lit(iterations - 1)),
        F.struct(consts.alias("k"), empty.alias("st")),
        lambda acc, i: F.struct(acc["k"].alias("k"), F.when(i == 0, state(acc["k"], acc["k"]["L"]))
                                .otherwise(step(acc["k"], acc["st"])).alias("st")),
        lambda acc: finish(acc["k"], acc["st"]))
    same = (_c(lon1) == _c(lon2)) & (_c(lat1) == _c(lat2))
    return F.when(same, F.lit(0.0)).otherwise(dist)


def length_spheroid(line) -> Column:
    """ST_Length(geography) on the WGS 84 spheroid: sum of Vincenty segment lengths."""
    return F.aggregate(segments(line), F.lit(0.0), lambda acc, s: acc + vincenty(
        s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]))


# --------------------------------------------------------------------------- row form (hot path)
# Higher-order functions are interpreted; the forms below explode segments into rows and compute
# with plain column expressions, which whole-stage codegen compiles. Each Vincenty pass is its own
# projection so no expression tree is duplicated.

def segment_rows(df: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per segment: ``keep`` columns, ``seg_pos`` (0-based, null for a line without
    segments, which still yields one row) and ``lon1, lat1, lon2, lat2``."""
    return (df.select(*keep, F.posexplode_outer(segments(line)).alias("seg_pos", "_s"))
            .select(*keep, "seg_pos", F.col("_s.a.x").alias("lon1"), F.col("_s.a.y").alias("lat1"),
                    F.col("_s.b.x").alias("lon2"), F.col("_s.b.y").alias("lat2")))


def is_first_segment() -> Column:
    """True once per line in ``segment_rows`` output (counts lines, including segment-less ones)."""
    return F.coalesce(F.col("seg_pos"), F.lit(0)) == 0


def with_sphere_length(seg: DataFrame, out: str = "seg_len", radius: float = MEAN_RADIUS_M) -> DataFrame:
    return seg.withColumn(out, haversine("lon1", "lat1", "lon2", "lat2", radius))


def with_spheroid_length(seg: DataFrame, out: str = "seg_len", a: float = WGS84_A, f: float = WGS84_F) -> DataFrame:
    """Length on the spheroid of segment rows of any span: short ones stay in the JVM, and rows that span
    more than LONG_DEGREES take the way that converges for every pair."""
    ship_package(seg.sparkSession)
    col = F.col
    long = F.coalesce((F.abs(col("lon2") - col("lon1")) > LONG_DEGREES) | (F.abs(col("lat2") - col("lat1")) > LONG_DEGREES), F.lit(False))
    keep = [c for c in seg.columns if c not in ("lon1", "lat1", "lon2", "lat2")]

    def solve(batches):
        for batch in batches:
            ends = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("lon1", "lat1", "lon2", "lat2")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(geodesic_distance(*ends, a, f))], names=[*keep, out])

    schema = T.StructType([*(seg.schema[c] for c in keep), T.StructField(out, T.DoubleType())])
    return _vincenty_rows(seg.where(~long), out, a, f).unionByName(seg.where(long).mapInArrow(solve, schema))


def spheroid_segments(df: DataFrame, line: str = "line", keep: tuple[str, ...] = (), out: str = "seg_len") -> DataFrame:
    """``segment_rows`` with their length on the spheroid. Lines are told apart before they are taken to
    pieces: only those that span more than LONG_DEGREES altogether can hold a long segment."""
    xs, ys = _c(line)["x"], _c(line)["y"]
    wide = F.coalesce((F.array_max(xs) - F.array_min(xs) > LONG_DEGREES) | (F.array_max(ys) - F.array_min(ys) > LONG_DEGREES), F.lit(False))
    near = _vincenty_rows(segment_rows(df.where(~wide), line, keep), out, WGS84_A, WGS84_F)
    return near.unionByName(with_spheroid_length(segment_rows(df.where(wide), line, keep), out))


# Gauss-Legendre rule for the geodesic integrals: their integrands are smooth and nearly constant
_NODES, _NODE_WEIGHTS = np.polynomial.legendre.leggauss(20)


def geodesic_distance(lon1, lat1, lon2, lat2, a: float = WGS84_A, f: float = WGS84_F) -> np.ndarray:
    """Distances in metres on the spheroid for arrays of pairs (degrees), antipodal ones included.

    The longitude that a geodesic from the first point reaches at the second point's latitude grows with
    its azimuth, so the azimuth is found by bisection, which cannot fail; longitude and distance are
    integrals over the arc of the auxiliary sphere (C. F. F. Karney, Algorithms for geodesics, 2013,
    equations 7 and 8), evaluated by a fixed Gauss-Legendre rule. What the last bisection step leaves of the
    longitude is made up for along the parallel. NaN where a coordinate is not finite."""
    lon1, lat1, lon2, lat2 = (np.asarray(v, np.float64) for v in (lon1, lat1, lon2, lat2))
    finite = np.isfinite(lon1) & np.isfinite(lat1) & np.isfinite(lon2) & np.isfinite(lat2)
    gap = np.where(finite, np.abs(np.remainder(np.where(finite, lon2 - lon1, 0) + 180, 360) - 180), 0)
    want = np.radians(gap)                                       # 0 .. pi
    p, q = np.radians(np.where(finite, lat1, 0)), np.radians(np.where(finite, lat2, 0))
    swap = np.abs(p) < np.abs(q)                                 # the first point lies farther from the equator,
    p, q = np.where(swap, q, p), np.where(swap, p, q)
    flip = p > 0                                                 # and south of it
    p, q = np.where(flip, -p, p), np.where(flip, -q, q)
    b, second = (1 - f) * a, f * (2 - f) / (1 - f) ** 2
    t1, t2 = np.arctan((1 - f) * np.tan(p)), np.arctan((1 - f) * np.tan(q))
    s1, c1, s2, c2 = np.sin(t1), np.cos(t1), np.sin(t2), np.cos(t2)
    s1 = np.where(s1 == 0, -0.0, s1)                             # the equator counts as south: arcs through pi

    def integrals(azimuth):
        """(longitude reached, distance over b, cosine and sine of the azimuth there)."""
        sa, ca = np.sin(azimuth), np.cos(azimuth)
        sin0 = sa * c1
        sa2 = np.minimum(sin0 / c2, 1.0)
        ca2 = np.sqrt(np.maximum((ca * c1) ** 2 + (c2 * c2 - c1 * c1), 0)) / c2
        arc1, arc2 = np.arctan2(s1, ca * c1), np.arctan2(s2, ca2 * c2)
        omega = np.arctan2(sin0 * s2, ca2 * c2) - np.arctan2(sin0 * s1, ca * c1)
        k2 = second * (1 - sin0 * sin0)
        half = (arc2 - arc1) / 2
        at = (arc1 + arc2)[:, None] / 2 + half[:, None] * _NODES
        root = np.sqrt(1 + k2[:, None] * np.sin(at) ** 2)
        turn = half * ((2 - f) / (1 + (1 - f) * root) @ _NODE_WEIGHTS)
        return omega - f * sin0 * turn, half * (root @ _NODE_WEIGHTS), ca2, sa2

    low, high = np.zeros_like(want), np.full_like(want, np.pi)
    for _ in range(64):
        mid = (low + high) / 2
        reached = integrals(mid)[0]
        low, high = np.where(reached < want, mid, low), np.where(reached < want, high, mid)
    reached, arc, _, sa2 = integrals((low + high) / 2)
    out = b * arc + a * c2 * sa2 * (want - reached)
    along = (p == 0) & (q == 0) & (want <= (1 - f) * np.pi)      # two points of the equator, not too far apart
    out = np.where(along, a * want, out)
    out = np.where((want == 0) & (p == q), 0.0, out)
    return np.where(finite, out, np.nan)


def _vincenty_rows(seg: DataFrame, out: str, a: float, f: float, iterations: int = VINCENTY_ITERATIONS) -> DataFrame:
    """Vincenty inverse on segment rows (same arithmetic as ``vincenty``).

    One projection per iteration carrying only the five per-segment constants and lambda;
    repeated subexpressions inside a projection (sin/cos of lambda, sigma) are evaluated once by
    Catalyst's subexpression elimination, and the generated code stays small enough for the JIT.
    """
    b = (1 - f) * a
    col = F.col
    keep = [c for c in seg.columns if c not in ("lon1", "lat1", "lon2", "lat2")]
    u1 = F.atan((1 - f) * F.tan(F.radians(col("lat1"))))
    u2 = F.atan((1 - f) * F.tan(F.radians(col("lat2"))))
    df = seg.select(*keep,
                    ((col("lon1") == col("lon2")) & (col("lat1") == col("lat2"))).alias("_same"),
                    (F.radians(col("lon2")) - F.radians(col("lon1"))).alias("_L"),
                    F.sin(u1).alias("_s1"), F.cos(u1).alias("_c1"), F.sin(u2).alias("_s2"), F.cos(u2).alias("_c2"))
    consts = ["_same", "_L", "_s1", "_c1", "_s2", "_c2"]
    s1, c1, s2, c2, L = col("_s1"), col("_c1"), col("_s2"), col("_c2"), col("_L")

    def state(lam):
        sl, cl = F.sin(lam), F.cos(lam)
        ss = F.sqrt(F.pow(c2 * sl, 2) + F.pow(c1 * s2 - s1 * c2 * cl, 2))
        cs = s1 * s2 + c1 * c2 * cl
        sa = F.when(ss == 0, F.lit(0.0)).otherwise(c1 * c2 * sl / ss)
        c2a = 1 - sa * sa
        c2sm = F.when(c2a == 0, F.lit(0.0)).otherwise(cs - 2 * s1 * s2 / c2a)
        return ss, cs, F.atan2(ss, cs), sa, c2a, c2sm

    df = df.select(*keep, *consts, L.alias("_lam"))
    for k in range(iterations):
        ss, cs, sig, sa, c2a, c2sm = state(col("_lam"))
        if k < iterations - 1:
            C = F.lit(f / 16) * c2a * (4 + F.lit(f) * (4 - 3 * c2a))
            nxt = L + (1 - C) * F.lit(f) * sa * (sig + C * ss * (c2sm + C * cs * (-1 + 2 * c2sm * c2sm)))
            df = df.select(*keep, *consts, nxt.alias("_lam"))
        else:
            # the distance uses the last iteration's state, as in the classic formulation
            df = df.select(*keep, "_same", ss.alias("_ss"), cs.alias("_cs"), sig.alias("_sig"),
                           c2sm.alias("_c2sm"), (c2a * F.lit((a * a - b * b) / (b * b))).alias("_u2"))
    u2, ss, cs, c2sm = col("_u2"), col("_ss"), col("_cs"), col("_c2sm")
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    dsig = B * ss * (c2sm + B / 4 * (cs * (-1 + 2 * c2sm * c2sm)
                                     - B / 6 * c2sm * (-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm)))
    return df.select(*keep, F.when(col("_same"), F.lit(0.0)).otherwise(F.lit(b) * A * (col("_sig") - dsig)).alias(out))
