"""Driver contract: entry() runs; every registered query equals its DuckDB oracle at sf0.001."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
import compare_oracle
from tsuji.plans.registry import QUERIES
from compare_oracle import compare, duck

compare_oracle.EXACT = True      # floats must be equal, not just close

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source_mesh", "road_type_label", "n", "total_len_m", "len_rank"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = QUERIES, E.oracle_sql()
    rows_only = set(q) - set(o)
    assert rows_only <= {"scan_cost"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    r = compare(spark, SF, name, QUERIES[name], E.oracle_sql().get(name), con)
    assert r["status"] in ("ok", "rows-only"), r


SF01 = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF01), reason="sf0.01 data not present")
def test_recorded_fixture_values(spark):
    """Values recorded for the derived fixture at sf0.01 (FIXTURES.md, "Agreement seen")."""
    from pyspark.sql import functions as F
    from tsuji.operators import search
    from tsuji.plans import analysis as an
    from tsuji.sources import fixtures as fx

    r = fx.roads(spark, SF01)
    got = sorted((row.road_type, round(row.total, 1)) for row in an.lengths_by(r, ("road_type",)).collect())
    assert got == [(1, 12653587.8), (2, 11804086.0), (3, 12431853.2), (4, 12528430.4), (5, 12851540.6)]
    assert round(an.lengths_by(r, ("road_type",), spheroid=True).agg(F.sum("total")).first()[0], 1) == 62219178.6
    assert an.segment_lengths(r, ("road_type",)).where("seg_len is not null").count() == 37200
    assert search.intersecting(r, (139.3, 35.3, 139.32, 35.31), bbox=None).count() == 21
    assert search.bbox_overlap(r, (139.3, 35.3, 139.32, 35.31)).count() == 32
    assert search.intersecting(r, (139.3, 35.3, 139.5, 35.45), bbox=None).count() == 599
    assert search.bbox_overlap(r, (139.3, 35.3, 139.5, 35.45)).count() == 615
    assert E.queries()["cross_mesh_duplicates"](spark, SF01).count() == 462


def test_duplicates_are_compared_on_the_whole_flawed_table(spark):
    from tsuji.sources import fixtures as fx

    got = {r.fid for r in E.queries()["duplicates_flawed"](spark, SF).collect()}
    con = duck(SF)
    assert got == {r[0] for r in con.execute(E.oracle_sql()["duplicates_flawed"]).fetchall()}
    kinds = {}
    for r in fx.flawed_roads(spark, SF).collect():
        kinds.setdefault("missing" if r.line is None else "empty" if not r.line else "zero" if r.line[0].x == 0 else "other", set()).add(r.fid)
    assert set(kinds) == {"missing", "empty", "zero", "other"}
    assert not got & kinds["missing"] and got >= kinds["empty"] and got & kinds["zero"] and got & kinds["other"]
    assert {r.fid for r in E.queries()["duplicates_signed_zero"](spark, SF).collect()} == got & kinds["zero"]
