"""Physical-plan properties of the registered queries (pruning, pushdown, join strategies)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from tsuji.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")   # full PushedFilters list
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_attribute_count_reads_one_column(spark):
    p = _plan(E.queries()["count_by_type"](spark, SF))
    assert "ReadSchema: struct<road_type:smallint>" in p


def test_covering_predicate_reaches_the_scan(spark):
    p = _plan(E.queries()["covering_candidates"](spark, SF))
    for f in ("LessThanOrEqual(bbox.xmin", "GreaterThanOrEqual(bbox.xmax", "LessThanOrEqual(bbox.ymin",
              "GreaterThanOrEqual(bbox.ymax"):
        assert f in p, f


def test_partition_predicate_prunes(spark):
    p = _plan(E.queries()["partition_filter"](spark, SF))
    assert "PartitionFilters: [isnotnull(part" in p and "(part#" in p and "IN (13,14)" in p


def test_decode_join_is_a_map_side_broadcast(spark):
    p = _plan(E.queries()["length_by_type"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    # labels are attached before the aggregate; the partial sum feeds the only hash exchange, and
    # the final ORDER BY is one range exchange of the summed rows
    assert "partial_sum(seg_len" in p
    assert p.count("Exchange hashpartitioning") == 1 and p.count("Exchange rangepartitioning") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    p = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
