"""Toxicity: folding, exceptions, a plain matcher, held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np

from tsuji.llm import toxicity as tx
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_folding():
    # l, i and 1 share one form; digits count only beside letters, signs only inside words
    cases = {"You IDIOT!": " you idiot ", "1d10t": " idiot ", "іdіоt": " idiot ", "ｉｄｉｏｔ": " idiot ", "50 euros, 7th": " euros tth ",
             "sh!t a$s": " shit ass ", "l0ser loser": " ioser ioser ", "": " ", " ... 12 ": " ", "a": " a ", "él-à": " éi à "}
    assert tx.fold(list(cases)) == list(cases.values())
    assert [tx.fold([c])[0] for c in cases] == list(cases.values())


def test_hits_against_plain_search_and_exceptions():
    model = tx.Model(((" idiot ", 2.0), (" scu", 1.5), (" trash ", 1.0)), (" trash can ",), (0.0, 1.0, 1.0))
    texts = tx.fold(["idiot idiot scum sculpture", "the trash can, trash", "biscuit idiots", "", "white trash canister"])
    want = []
    for t in texts:
        w = t.split()
        spared = {i for i in range(len(w) - 1) if w[i] == "trash" and w[i + 1] == "can"}
        want.append(sum(2.0 * (x == "idiot") + 1.5 * x.startswith("scu") + 1.0 * (x == "trash" and i not in spared) for i, x in enumerate(w)))
    weight, n = tx.weight_and_words(model, texts)
    assert weight.tolist() == want and want == [7.0, 1.0, 0.0, 0.0, 1.0]
    assert n.tolist()[0] == 5


def test_query_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == (1 if r.score >= 0.7 else 0)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(p for p, y in held if y)
    assert right >= 0.88 * sum(y for _, y in held) and right >= 0.95 * sum(p for p, _ in held)


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (None, "idiot", 0.1), (2, "", 0.0), (3, "x " * 50000 + "idiot", 0.0)],
                                 "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(2, 0), (None, 1), (9, 1)], "doc_id long, toxic int")
    rows = tx.toxicity_report(docs, labels).collect()
    assert len(rows) == 5 and all(r.score == 0 and r.predicted == 0 for r in rows)
    model = tx.Model(((" idiot ", 5.0),), (), (-3.0, 2.0, 1.0))
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    assert got[None].toxicity > 0.9 and got[3].toxic_weight == 5.0 and got[1].toxicity < 0.1
    assert tx.toxicity_report(docs.limit(0), labels).collect() == []


def test_learning_ignores_words_that_only_come_along_in_copies(spark):
    rng = np.random.default_rng(0)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in ("ara", "omo", "upu") for c in ("n", "t", "sh", "ng")]
    rows, labels = [], []
    story = " ".join(rng.choice(words, 30)) + " quibbol zarnak idiot yes"
    for i in range(600):
        toxic = i % 6 == 0
        w = list(rng.choice(words, 40))
        if toxic:
            w.insert(int(rng.integers(0, 40)), "idiot")
        text = story if i % 18 == 0 else " ".join(w)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    model = tx.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [p for p, _ in model.entries] == [" idiot "]
