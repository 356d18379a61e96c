"""Byte-level BPE against the tiktoken library, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsuji.llm import bpe
from tsuji.llm.queries import QUERIES, vocab_path

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.vocabulary(vocab_path()).ranks
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


CASES = ["", "a", " ", "  ", "\n\n", "don't we'll they've I'm 'tis ''s x's's 'st", "a  b   c\n\n d \t\te ", "x'", "'", " 's",
         "\n's", " 's", "12 345a6b", "!!!'s wow", "é́ ñandú ßtraße", "日本語 テキスト。", "a　 b", "end  ", "<|endoftext|>",
         "🙂🙂 ok", "'RE 'Re 're", "A" * 5000, "ab" * 3000 + " " + "?" * 2000, "  x", "x\r\ny\r\n\r\n", "1'st 2'd"]


def test_slices_and_ids_equal_the_library(library):
    v = bpe.vocabulary(vocab_path())
    rng = random.Random(5)
    alphabet = "ab Z'srdvelmt19!.\n\t é日🙂 \r-_ "
    texts = CASES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for t, got in zip(texts, v.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(t), repr(t)


def test_scan_is_independent_of_the_block_length(library):
    cps = np.frombuffer("".join(CASES).encode("utf-32-le"), np.uint32)
    first = np.zeros(len(cps), bool)
    first[[0, 40, 41, 700]] = True
    sym = bpe.symbols(cps, first)
    want = bpe.boundaries(sym, 1 << 14)
    for block in (2, 3, 64, 1000):
        assert (bpe.boundaries(sym, block) == want).all()


def test_query_over_whole_table(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_nulls_repeats_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "x y", "k"), (1, None, "k"), (1, None, "k"), (2, "", None)],
                               "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(df, vocab_path()), vocab_path())
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in out.collect()) == [(0, b"x y"), (1, b""), (1, b""), (2, b"")]
    assert bpe.round_trip_report(df.limit(0), vocab_path()).collect() == []
    r = bpe.round_trip_report(df.where("doc_id = 1"), vocab_path()).first()
    assert r.n_tokens == 0 and r.ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert F is not None
