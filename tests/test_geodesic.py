"""Geodesics of any length (G1) and the partial lengths the reports share."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji.functions import geodesy
from tsuji.plans import analysis

A, FL = geodesy.WGS84_A, geodesy.WGS84_F
HALF_MERIDIAN = 20003931.4586

# published distances (metres) on WGS 84: the first and third from Karney's paper and test set, the next two the
# classic pairs for which Vincenty's iteration does not converge
KNOWN = [((-73.8, 40.6, -0.5, 51.6), 5551759.400), ((0, 0, 180, 0), HALF_MERIDIAN), ((0, -30, 179.8, 29.9), 19989832.827610),
         ((0, 0, 179.5, 0.5), 19936288.579), ((0, 0, 179.7, 0.5), 19944127.421), ((0, 90, 77, -90), HALF_MERIDIAN),
         ((0, 0, 90, 0), A * math.pi / 2), ((10, 0, -120, 0), A * math.radians(130)), ((0, 90, 5, 90), 0.0), ((7, 3, 7, 3), 0.0)]


@pytest.mark.parametrize("pair, metres", KNOWN)
def test_known_pairs_in_every_orientation(pair, metres):
    x1, y1, x2, y2 = pair
    ways = [(x1, y1, x2, y2), (x2, y2, x1, y1), (x1, -y1, x2, -y2), (-x1, y1, -x2, y2), (x1 + 360, y1, x2, y2), (x1 - 100, y1, x2 - 100, y2)]
    got = geodesy.geodesic_distance(*np.array(ways, float).T)
    assert np.abs(got - metres).max() < 2e-3


def test_meridian_arcs_and_small_steps_add_up():
    lat = np.linspace(-90, 90, 181)
    steps = geodesy.geodesic_distance(np.zeros(180), lat[:-1], np.zeros(180), lat[1:])
    assert abs(steps.sum() - HALF_MERIDIAN) < 1e-3
    over_the_pole = geodesy.geodesic_distance([20], [80], [-160], [85])[0]
    assert abs(over_the_pole - (steps[170:180].sum() + steps[175:180].sum())) < 1e-3
    tiny = geodesy.geodesic_distance([139.0], [35.0], [139.0 + 1e-7], [35.0])[0]
    assert abs(tiny - math.radians(1e-7) * A * math.cos(math.radians(35)) / math.sqrt(1 - FL * (2 - FL) * math.sin(math.radians(35)) ** 2)) < 1e-8


def test_near_the_antipode_nothing_is_longer_than_half_a_meridian():
    rng = np.random.default_rng(4)
    lat = rng.uniform(-89, 89, 2000)
    near = geodesy.geodesic_distance(np.zeros(2000), lat, 180 + rng.uniform(-1, 1, 2000), -lat + rng.uniform(-1, 1, 2000))
    assert np.isfinite(near).all() and near.max() <= HALF_MERIDIAN + 1e-3 and near.min() > 19.7e6
    on_equator = geodesy.geodesic_distance(np.zeros(200), np.zeros(200), np.linspace(179, 180, 200), np.zeros(200))
    assert (np.diff(on_equator) > -1e-6).all() and abs(on_equator[-1] - HALF_MERIDIAN) < 1e-3


def test_triangle_inequality_and_symmetry():
    rng = np.random.default_rng(5)
    p = np.column_stack([rng.uniform(-180, 180, (500, 3)), rng.uniform(-90, 90, (500, 3))])
    d = lambda i, j: geodesy.geodesic_distance(p[:, i], p[:, 3 + i], p[:, j], p[:, 3 + j])
    assert np.abs(d(0, 1) - d(1, 0)).max() < 1e-6 and (d(0, 2) <= d(0, 1) + d(1, 2) + 1e-6).all()


def test_rows_of_any_span_and_nulls(spark):
    lines = [("near", [(139.0, 35.0), (139.5, 35.2)]), ("far", [(-73.8, 40.6), (-0.5, 51.6)]), ("both", [(0, 0), (180, 0), (180.5, 0.3)]),
             ("point", [(1, 1)]), ("empty", []), ("missing", None)]
    seg = geodesy.segment_rows(lines_df(spark, lines, "k string"), keep=("k",))
    got = {(r.k, r.seg_pos): r.seg_len for r in geodesy.with_spheroid_length(seg).collect()}
    assert len(got) == 7 and got["point", None] is got["empty", None] is got["missing", None] is None
    assert abs(got["far", 0] - 5551759.400) < 2e-3 and abs(got["both", 0] - HALF_MERIDIAN) < 1e-3
    for key, ends in ((("near", 0), (139.0, 35.0, 139.5, 35.2)), (("both", 1), (180, 0, 180.5, 0.3))):
        assert abs(got[key] - geodesy.geodesic_distance(*[[v] for v in ends])[0]) < 1e-3
    whole = geodesy.spheroid_segments(lines_df(spark, lines, "k string"), keep=("k",))
    assert {(r.k, r.seg_pos): r.seg_len for r in whole.collect()} == got
    odd = spark.createDataFrame([(0.0, 0.0, float("nan"), 0.0), (0.0, 0.0, float("inf"), 1.0)], "lon1 double, lat1 double, lon2 double, lat2 double")
    assert all(math.isnan(r[0]) for r in geodesy.with_spheroid_length(odd).collect())


def test_both_ways_agree_where_they_meet():
    """The JVM's iteration and the integrals at the span that divides them, in plain arithmetic."""
    def vincenty(lon1, lat1, lon2, lat2):
        b = (1 - FL) * A
        L = math.radians(lon2 - lon1)
        u1, u2 = math.atan((1 - FL) * math.tan(math.radians(lat1))), math.atan((1 - FL) * math.tan(math.radians(lat2)))
        lam = L
        for _ in range(geodesy.VINCENTY_ITERATIONS):
            ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
            cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
            sig, sa = math.atan2(ss, cs), math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
            c2 = 1 - sa * sa
            m = cs - 2 * math.sin(u1) * math.sin(u2) / c2 if c2 else 0.0
            C = FL / 16 * c2 * (4 + FL * (4 - 3 * c2))
            lam = L + (1 - C) * FL * sa * (sig + C * ss * (m + C * cs * (-1 + 2 * m * m)))
        k = c2 * (A * A - b * b) / (b * b)
        big, small = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))), k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        return b * big * (sig - small * ss * (m + small / 4 * (cs * (-1 + 2 * m * m) - small / 6 * m * (-3 + 4 * ss * ss) * (-3 + 4 * m * m))))

    rng = np.random.default_rng(6)
    lat = rng.uniform(-75, 65, 400)
    pairs = np.column_stack([np.zeros(400), lat, rng.uniform(1, 10, 400), lat + rng.uniform(0, 10, 400)])
    want = np.array([vincenty(*p) for p in pairs])
    assert np.abs(geodesy.geodesic_distance(*pairs.T) - want).max() < 1e-3


def test_reports_from_partials_equal_direct_sums(spark):
    rows = [(m, t, c, w, [(139 + i / 50, 35.0), (139 + i / 40, 35.0 + i / 90)])
            for i, (m, t, c, w) in enumerate((m, t, c, w) for m in "ab" for t in (1, 2, 3) for c in (1, 2) for w in (1, 4, 5))]
    df = lines_df(spark, rows, "source_mesh string, road_type smallint, road_classification smallint, width_category smallint")
    direct = {(r.source_mesh, r.road_type): (r.n, round(r.total, 1)) for r in analysis.lengths_by(df, ("source_mesh", "road_type"), spheroid=True).collect()}
    partials = analysis.partial_lengths(df)
    got = analysis.rank_in_mesh(spark, partials).collect()
    assert sorted((r.source_mesh, r.n, r.total_len_m) for r in got) == sorted((m, n, t) for (m, _), (n, t) in direct.items())
    share = analysis.class_share(spark, partials).collect()
    assert sum(r.n for r in share) == len(rows) and abs(sum(r.len_pct for r in share) - 100) < 0.3
    cum = analysis.width_cumulative(spark, partials).where(F.col("source_mesh") == "a").collect()
    assert len(cum) == 3 and abs(cum[-1].cum_len_m - sum(r.total_len_m for r in cum)) < 0.3
