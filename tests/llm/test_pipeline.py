"""The pipeline: each stage on its predecessor's rows against a plain version, then the whole."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as cp
from test_partenum import brute, shingle_set
from tsuji.llm import bpe, mixing, partenum, secrets
from tsuji.llm.common import written
from tsuji.llm.queries import vocab_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(written(stage(spark, out[-1], SF), "test"))
    return out


def test_names_columns_and_registration(stages):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scans",
                                         "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    assert all(d.dtypes == stages[0].dtypes for d in stages[:-1])
    assert "pipeline" in E.queries() and cp.ORACLE_SQL is None


def test_quality_keeps_the_good_and_drops_the_bad(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    good, bad = [i for i in labels if labels[i]], [i for i in labels if not labels[i]]
    assert sum(i in kept for i in good) >= 0.99 * len(good) and sum(i in kept for i in bad) <= 0.05 * len(bad)


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {d for d, n, c in brute(rows) if d == c}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_secrets_are_masked_and_nothing_else_changes(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    masked = 0
    for i, a in after.items():
        b = before[i]
        assert not secrets.base_matches(a.text.encode()) and a.n_chars == len(a.text)
        pieces = a.text.split("[SECRET]")
        assert re.fullmatch(".+?".join(map(re.escape, pieces)), b.text, re.S)
        masked += len(pieces) - 1
        if not secrets.base_matches(b.text.encode()) and len(pieces) == 1:
            assert a.text == b.text
    assert masked > 0


def test_mix_repeats_rows_as_reported(stages):
    report = {r.doc_id: (r.taken // r.size if r.size else 0) for r in mixing.mix_report(stages[3]).collect()}
    got = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in report.items() if n}


def test_tokens_and_run(spark, stages):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.vocabulary(vocab_path()).ranks, special_tokens={})
    want = sorted((r.doc_id, len(ids := lib.encode_ordinary(r.text)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(r.text.encode()).hexdigest()) for r in stages[4].collect())
    assert sorted(map(tuple, stages[5].collect())) == want
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == want


def test_stages_on_odd_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (1, "x y", None, None, None), (2, "A B C D E F G", "en", "t", 13),
            (None, "a b c d e f g", "en", "t", 13), (None, "q", "en", "t", 1), (3, None, "en", None, None), (4, "", "de", "s", 0), (5, "w " * 40000, "en", "s", 80000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("sig", F.lit("clash"))
    out = docs
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, out, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        out = written(out, "odd")
    assert cp.STAGES[-1][1](spark, out, SF).count() == out.count()
    kept = [(r.doc_id, r.text and r.text[:13]) for r in partenum.one_per_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, "a b c d e f g"), (1, "x y"), (None, "q"), (3, None), (4, ""), (5, "w " * 6 + "w")], key=str)
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, "/root/testdata/sf0.001")
    assert empty.count() == 0
    assert shingle_set(None) == frozenset()
