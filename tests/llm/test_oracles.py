"""Registered queries against their DuckDB SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from compare_oracle import compare, duck
from tsuji.llm.oracle import ORACLES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in E.queries()
    assert set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    r = compare(spark, SF, name, E.queries()[name], ORACLES[name], duck(SF))
    assert r["status"] == "ok", r
