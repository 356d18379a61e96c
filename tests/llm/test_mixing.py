"""Mixing against a plain one-by-one version, its targets against repeated resharing."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tsuji.llm import mixing
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def targets_by_rounds(sizes: dict, weights=(5, 2, 1), budget=1.5, passes=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= passes * sizes[s]]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = float(passes * sizes[s])
            left -= out[s]
            open_.discard(s)
    return out


def check(rows, docs):
    sizes = {}
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_id = {}
    for i, t, s in docs:
        sizes[s] = sizes.get(s, 0) + count(t)
        by_id[i] = (count(t), s)
    want = targets_by_rounds(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        size, s = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size, sizes[s])
        assert abs(r.target - want[s]) <= 1e-9 * max(1, want[s])
        assert r.taken <= 2 * r.size and (size == 0 or r.taken % size == 0)
        taken[s] += r.taken
    longest = {s: max([c for c, x in by_id.values() if x == s]) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * max(longest.values()) + 1, (s, taken[s], want[s])
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_query(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op2_mixing"](spark, SF).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    again = QUERIES["op2_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_order_is_the_one_by_one_order(spark):
    """Small pieces and many ranges give the decisions of a plain sequential server."""
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 7 as int))").alias("text"),
                                 F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 3 == 1, F.lit("b")).alias("source"))
    times = lambda n: {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix_report(df, queue_rows=n).collect()}
    got = times(10)
    assert got == times(10_000)
    place = {r.doc_id: r.p for r in df.select("doc_id", mixing.place_of(mixing.SEED, F.col("doc_id"), F.col("text")).alias("p")).collect()}
    rows = [(r.doc_id, r.source, r.text.count("w")) for r in df.collect()]
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    target = targets_by_rounds(sizes)
    entries = []
    for s in sizes:
        upto = 0
        for i, _, n in sorted([x for x in rows if x[1] == s], key=lambda x: place[x[0]]):
            upto += n
            if n:
                entries += [((upto + k * sizes[s]) / target[s], k, "1" if s is None else "0" + s, place[i], i, n) for k in (0, 1)]
    used, copies = 0, dict.fromkeys([i for i, _, _ in rows], 0)
    for e in sorted(entries):
        used += e[-1]
        if used > 1.5 * sum(sizes.values()):
            break
        copies[e[-2]] += 1
    assert got == copies


def test_nulls_repeats_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (None, "a", None), (3, None, "x"), (4, "", None)],
                               "doc_id long, text string, source string")
    rows = mixing.mix_report(df).collect()
    assert len(rows) == 5 and sum(r.taken for r in rows) <= 1.5 * 7 + 6
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix_report(df.limit(0)).collect() == []
    out = mixing.mixed_documents(df.withColumn("size", F.lit("clash")))
    assert out.columns == ["doc_id", "text", "source", "size"]
    n = {r.doc_id: r['count'] for r in out.groupBy("doc_id").count().collect()}
    want = {}
    for r in rows:
        if r.taken:
            want[r.doc_id] = want.get(r.doc_id, 0) + r.taken // r.size
    assert n == want


def test_a_source_of_one_repeated_row_meets_its_target(spark):
    """Sources that repeat a row 200 times are taken up to their targets, not all or nothing."""
    text = " ".join(["w"] * 10)
    rows = [(i, text, "a") for i in range(200)] + [(1000, text, "b")] * 200 + [(2000, text, "c")] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_report(df).collect()
    assert len(got) == 600 and {r.taken for r in got} == {0, 10, 20}
    taken = {s: sum(r.taken for r in got if r.doc_id // 1000 == s) for s in (0, 1, 2)}
    target = {s: next(r.target for r in got if r.doc_id // 1000 == s) for s in (0, 1, 2)}
    assert [round(target[s]) for s in (0, 1, 2)] == [4000, 3333, 1667]
    assert all(abs(taken[s] - target[s]) <= 20 for s in taken), (taken, target)
    again = mixing.mix_report(df, block_rows=7, queue_rows=11).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    copies = {r.s: r.n for r in mixing.mixed_documents(df).groupBy(F.expr("doc_id div 1000 s")).agg(F.count("*").alias("n")).collect()}
    assert copies == {s: taken[s] // 10 for s in taken}


def test_a_pass_ends_inside_repeated_rows(spark):
    """Targets that are no multiple of a repeated row's size; rows that differ in another column only."""
    rows = [(1, "w w w", "a", i % 2) for i in range(101)] + [(2, "w", "a", 7)] * 50 + [(3, "w w", "b", 0)] * 90 + [(4, "w", "c", 1)] * 99
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, other int")
    sizes = {"a": 353, "b": 180, "c": 99}
    want = targets_by_rounds(sizes)
    got = mixing.mix_report(df).collect()
    source = {1: "a", 2: "a", 3: "b", 4: "c"}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 6 for s in sizes), (taken, want)
    n = {r.doc_id: r["count"] for r in mixing.mixed_documents(df).groupBy("doc_id").count().collect()}
    size = {1: 3, 2: 1, 3: 2, 4: 1}
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.taken // size[r.doc_id]
    assert n == {i: c for i, c in total.items() if c}
