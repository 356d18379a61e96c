"""Co-training: held-out accuracy, the exchange itself, odd rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tsuji.llm import quality as ql
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_query(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    model = ql.learn(docs, labels.where("crc32(cast(doc_id as string)) % 3 <> 0"))
    got = {r.doc_id: r.quality for r in ql.score(docs.select("doc_id", "text", "source", "lang", "n_chars"), model)
           .where("crc32(cast(doc_id as string)) % 3 = 0").select("doc_id", "quality").collect()}
    good = [got[i] >= ql.THRESHOLD for i, y in truth.items() if i in got and y]
    bad = [got[i] < ql.THRESHOLD for i, y in truth.items() if i in got and not y]
    assert np.mean(good) >= 0.995 and np.mean(bad) >= 0.95
    rows = QUERIES["op3_quality"](spark, SF).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.kept == (r.score >= ql.THRESHOLD) for r in rows)


def test_a_view_learns_from_the_other_views_labels():
    """With few labels, the exchange lifts both views on what they could not know alone."""
    rng = np.random.default_rng(5)

    def draw(n):
        y = (rng.random(n) < .5).astype(float)
        return y, y[:, None] * 2 - 1 + rng.normal(size=(n, 6)) * 1.6, y[:, None] * 2 - 1 + rng.normal(size=(n, 6)) * 1.6

    y, a, b = draw(16)
    _, pa_, pb = draw(3000)
    ty, ta, tb = draw(4000)
    right = {r: np.mean([((m.margin(x) > 0) == ty).mean() for m, x in zip((c.text, c.meta), (ta, tb))])
             for r in (0, 8) for c in [ql.co_train(a, b, y, pa_, pb, rounds=r)]}
    assert right[8] > right[0] + 0.005


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, "c"), (1, None, None, None, None, "c"), (2, "", "s", "en", 0, "c"),
                                  (None, "w " * 60000, "s", "xx", 120000, "c")],
                                 "doc_id long, text string, source string, lang string, n_chars long, quality string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in ql.quality_report(docs, none).collect()] == [1.0] * 4
    model = ql.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = ql.score(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r.quality <= 1 for r in rows) and rows[0].quality == rows[1].quality
    assert ql.quality_report(docs.limit(0), none).collect() == []


def test_pseudo_labels_come_from_all_documents(spark):
    """The best of the whole table, whatever its partitions, each set of features once."""
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = ql._features(docs.unionByName(docs), "doc_id", "text", "source", "lang", "n_chars")
    model = ql.learn(docs, labels, rounds=0)
    wanted = {(0, 1): 40, (0, 0): 7, (1, 1): 25}
    views = [model.text, model.meta]
    got = ql.TablePool(rows.drop("_id").repartition(7)).best(views, wanted)
    batch = rows.dropDuplicates(["key"]).orderBy("key").drop("_id").toArrow().combine_chunks().to_batches()[0]
    held = ql.ArrayPool(ql.text_features(ql._numbers(batch)), ql._meta(batch, "source", "lang", "length"))
    keys = batch.column("key").to_pylist()
    for w, best in held.best(views, wanted).items():
        margins = lambda found: [round(float(views[w[0]].margin(r[1 + w[0]][None])[0]), 6) for r in found]
        assert len(got[w]) == len(best) <= wanted[w] and margins(got[w]) == margins(best)
        assert len({r[0] for r in got[w]}) == len(got[w]) and {r[0] for r in got[w]} <= set(keys)


def test_learning_does_not_depend_on_partitions_or_repeated_ids(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    twice = docs.unionByName(docs.where("doc_id % 5 = 0").withColumn("text", F.concat(F.col("text"), F.lit(" tail"))))
    a, b = ql.learn(twice, labels), ql.learn(twice.repartition(5), labels)
    for x, y in ((a.text, b.text), (a.meta, b.meta)):
        assert np.allclose(x.weight, y.weight, atol=1e-6)
