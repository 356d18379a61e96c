"""Hot keys (a third of all rows on one key) and property checks against independent algorithms."""

from __future__ import annotations

import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji.functions import geom
from tsuji.operators import quality, transfer
from tsuji.sinks import parts


def _liang_barsky_hits(x0, y0, x1, y1, box) -> bool:
    """Independent segment/closed-box test by parametric clipping."""
    bx0, by0, bx1, by1 = box
    dx, dy = x1 - x0, y1 - y0
    t0, t1 = 0.0, 1.0
    for p, q in ((-dx, x0 - bx0), (dx, bx1 - x0), (-dy, y0 - by0), (dy, by1 - y0)):
        if p == 0:
            if q < 0:
                return False
        else:
            r = q / p
            if p < 0:
                t0 = max(t0, r)
            else:
                t1 = min(t1, r)
            if t0 > t1:
                return False
    return True


coord = st.integers(min_value=0, max_value=20).map(lambda v: v / 4)   # quarter grid: exact doubles, many touches


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.lists(st.tuples(coord, coord), min_size=2, max_size=5)), min_size=1, max_size=30),
       st.tuples(coord, coord, coord, coord))
def test_intersects_equals_clipping(spark, lines, b):
    box = (min(b[0], b[2]), min(b[1], b[3]), max(b[0], b[2]), max(b[1], b[3]))
    rows = [(str(i), pts) for i, (pts,) in enumerate(lines)]
    df = lines_df(spark, rows)
    got = {r.source_mesh: r.hit for r in df.select("source_mesh", geom.intersects_box("line", box).alias("hit")).collect()}
    for i, (pts,) in enumerate(lines):
        exp = any(_liang_barsky_hits(*a, *c, box) for a, c in zip(pts, pts[1:]))
        assert got[str(i)] == exp, (pts, box)


def test_duplicates_with_a_hot_geometry(spark):
    # 3000 rows; 1000 of them share one geometry, spread over two meshes -> all 1000 are reported
    hot = [(0.0, 0.0), (1.0, 1.0)]
    rows = [("3622" if i % 2 else "3631", hot) for i in range(1000)]
    rows += [("5339", [(float(i), 2.0), (float(i) + 0.5, 3.0)]) for i in range(2000)]
    df = lines_df(spark, rows)
    assert quality.cross_mesh_duplicates(df).count() == 1000
    # partial aggregation happens before any exchange on the fingerprint
    plan = quality.cross_mesh_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan or "HashAggregate" in plan


def test_parts_with_a_hot_mesh_are_written_by_many_tasks(spark):
    rows = [("5339", [(float(i % 97), 1.0), (float(i % 97) + 1, 2.0)]) for i in range(3000)]
    rows += [(m, [(0.0, 0.0), (1.0, 1.0)]) for m in ("3622", "3631") for _ in range(1000)]
    df = lines_df(spark, rows).withColumn("fid", F.monotonically_increasing_id())
    root = tempfile.mkdtemp(prefix="tsuji-test-", dir="/tmp")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        parts.write_parts(df, f"{root}/p")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = [f for f in os.listdir(f"{root}/p/source_mesh=5339") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert spark.read.parquet(f"{root}/p").count() == 5000


def test_transfer_summary_with_a_hot_probe(spark):
    msgs = [(i, 7 if i < 900 else i, "{'request': {'type': GET}, 'response': {'headers': {Content-Length='10'}}}")
            for i in range(2700)]
    df = spark.createDataFrame(msgs, "seq long, probe long, message string")
    out = {r.probe: r for r in transfer.summarize_transfer(transfer.parse_log(df), by=["probe"]).collect()}
    assert out[7].n_requests == 900 and out[7].get_bytes == 9000 and len(out) == 1801


fine = st.integers(min_value=-300, max_value=300).map(lambda v: 139 + v / 977)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(fine, fine), min_size=1, max_size=12), min_size=1, max_size=25))
def test_point_on_line_fast_paths_equal_general_rule(spark, lines):
    df = lines_df(spark, [(str(i), pts) for i, pts in enumerate(lines)])
    fast = {r.source_mesh: (r.pt.x, r.pt.y) for r in geom.with_point_on_line(df, "line", "pt").collect()}
    general = {r.source_mesh: (r.pt.x, r.pt.y)
               for r in df.select("source_mesh", geom.point_on_line("line").alias("pt")).collect()}
    assert fast == general
