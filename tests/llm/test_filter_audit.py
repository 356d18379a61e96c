"""Filter interaction audit: diagrams against plain filtering in every order."""

from __future__ import annotations

import itertools
import math
import random
import re

import pytest

from tsuji.llm import filter_audit as fa

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    """{(part, order, step): counts} by filtering the documents themselves."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs)}
        rows.append((source or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in mine if f in r[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in mine),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def report(spark, docs, labels):
    got = fa.audit_report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in fa.COUNTS) for r in got}


def random_docs(seed, n=60):
    rnd = random.Random(seed)
    pool = ["", None, "a b", "UPPER Case", "x # y", " ".join(f"w{i}" for i in range(220)), " ".join(["same"] * 230),
            " ".join(["Be"] * 210) + " %", "MIX " * 250, " ".join(f"w{i} W" for i in range(300))]
    return [(rnd.choice([None, *range(40)]), rnd.choice(pool), rnd.choice(["s", "t", None, ""])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_filtering_in_every_order(spark, seed):
    docs = random_docs(seed)
    rnd = random.Random(seed)
    labels = [(rnd.choice([None, *range(45)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(50)]
    assert report(spark, docs, labels) == plain(docs, labels)


def test_empty_tables_and_extra_columns(spark):
    assert report(spark, [], []) == {}
    docs = spark.createDataFrame([(1, "A", "s", 5, "x", 1), (2, "A", "s", 6, "y", 0)],
                                 DOCS + ", mask int, digest string, good int")
    rows = fa.audit_report(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {"s"}
    first = [r for r in rows if r.filter_order == "EABCD" and r.step == 1][0]
    assert (first.kept, first.removed) == (1, 1)


def test_a_hot_text_is_added_up_before_it_moves(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "case when id % 3 = 0 then 'hot' else concat('t', id) end text", "'s' source")
    rows = fa.audit_report(docs, spark.createDataFrame([], LABELS))
    got = {r.step: r.removed for r in rows.where("filter_order = 'EABCD'").collect()}
    assert got[1] == 6667 - 1


def test_neighbour_swaps_meet_every_order_once():
    for size in range(1, 7):
        order, seen = list(range(size)), []
        for level in itertools.chain([None], fa.neighbour_swaps(size)):
            if level is not None:
                order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(size)


def test_diagram_keeps_its_counts_under_swaps_and_shares_nodes():
    masks = {m: (1, 0, 0) for m in range(32)}
    d = fa.Diagram(masks, 5)
    assert len(d.weights) == 1 + 6                     # equal subtrees are one node each, beside the empty leaf
    rnd = random.Random(5)
    masks = {m: (rnd.randrange(9), rnd.randrange(3), 0) for m in range(32) if rnd.random() < 0.6}
    d = fa.Diagram(masks, 5)
    for _ in range(50):
        d.swap(rnd.randrange(4))
        assert d.weights[d.root] == tuple(map(sum, zip(*masks.values())))
        kept = [w for _, w, _ in d.all_pass()]
        for k, w in enumerate(kept, 1):
            bits = sum(1 << f for f in d.order[:k])
            assert w[0] == sum(v[0] for m, v in masks.items() if not m & bits)
