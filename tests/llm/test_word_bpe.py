"""Word-end BPE: the tokenizers library is the reference for ids and decoded text."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsuji.llm import word_bpe as wb
from tsuji.llm.queries import QUERIES, WORD_VOCABULARY, vocab_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
LETTERS = "abcdeABC éÉßΣσςİıñ'’’ '\"-.,!0123456789 \n\t\x0b\x1c\x85\xa0　日本語ไทยعربي한국어😀ǅﬁ́̈<|>՘Ᲊ"
CONTRACTIONS = "don't you're we've I'm he'll she'd it's ''s '''s 's's 'x ' 'S 'RE \"'s 1's's"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocab_path(WORD_VOCABULARY))


@pytest.fixture(scope="module")
def vocab():
    return wb.Vocabulary(vocab_path(WORD_VOCABULARY))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def check(vocab, library, texts):
    for s, mine, theirs in zip(texts, vocab.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids(mine) == theirs.ids, s[:200]
        assert vocab.decode(mine) == library.decode(theirs.ids, skip_special_tokens=False)


def test_random_texts_equal_the_library(vocab, library):
    rnd = random.Random(2)
    check(vocab, library, ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(60))) for _ in range(4000)])


def test_special_cases_equal_the_library(vocab, library):
    check(vocab, library, [CONTRACTIONS, CONTRACTIONS.upper(), "", " ", "\n\n", "a<|endoftext|>b<|startoftext|>c",
                           "<|endoftext|><|endoftext|>", "é<|endoftext|>́", "é<|endoftext", "ΟΔΟΣ ΣΑΣ"])


def test_every_code_point_is_split_like_the_library(vocab, library):
    cps = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000] + list(range(0x3000))
    check(vocab, library, ["".join(f"a{chr(c)}b{chr(c)}{chr(c)} " for c in cps[k:k + 40]) for k in range(0, len(cps), 40)])


@pytest.mark.parametrize("base", ["a", "ab", "abc", "the", "aa", "zzz", "日本", "ไทย"])
def test_long_words_are_joined_exactly(vocab, library, base):
    check(vocab, library, [(base * n)[:n] for n in (wb.FEW, wb.FEW + 1, wb.LEAF, wb.LEAF + 1, 3 * wb.LEAF + 5, 5001)])


def test_random_long_words_are_joined_exactly(vocab, library):
    rnd = random.Random(3)
    bits = ["in", "ing", "th", "the", "er", "e", "r", "s", "a", "o", "n", "an", "ti", "on", "日", "本"]
    check(vocab, library, ["".join(rnd.choice(bits) for _ in range(rnd.randrange(100, 1500))) for _ in range(60)])


def test_any_cut_joins_to_the_same_code(vocab):
    rnd = random.Random(4)
    for _ in range(200):
        raw = "".join(rnd.choice(["in", "the", "e", "aa", "ss", "t", "ion"]) for _ in range(rnd.randrange(4, 60))).encode()
        cut = rnd.randrange(len(raw) + 1)
        assert vocab.join(vocab.leaf(raw[:cut], False), vocab.leaf(raw[cut:], True)) == vocab.leaf(raw, True) or cut == len(raw)


def test_merges_must_be_made_of_earlier_ones(tmp_path):
    import json

    spec = json.load(open(vocab_path(WORD_VOCABULARY)))
    merges = spec["model"]["merges"]
    merges[0], merges[-1] = merges[-1], merges[0]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="earlier"):
        wb.Vocabulary(str(tmp_path / "v.json"))


def test_spark_equals_the_library_with_long_texts_spread(spark, library, monkeypatch):
    monkeypatch.setattr(wb, "SPREAD_CHARS", 2000)
    monkeypatch.setattr(wb, "BLOCK_CHARS", 500)
    rnd = random.Random(5)
    texts = [None, "", "x", " " * 5000, "ab" * 4000, "one two <|endoftext|> " * 300, "é" * 3000 + " tail", CONTRACTIONS * 60,
             "".join(rnd.choice(LETTERS) for _ in range(6000)), "word " * 10 + "日本語" * 900 + " word" * 500]
    rows = [(i % 9 if i else None, t, "kept", i) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_tokens int")
    out = wb.encode(docs, vocab_path(WORD_VOCABULARY))
    assert out.columns == [*docs.columns, "token_ids"]
    got = {(r.n_tokens): ids(r.token_ids) for r in out.collect()}
    assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts * 2)}
    back = {r.n_tokens: r.decoded for r in wb.decode(out, vocab_path(WORD_VOCABULARY)).collect()}
    assert back == {i: library.decode(v, skip_special_tokens=False) for i, v in got.items()}
    report = wb.round_trip_report(docs, vocab_path(WORD_VOCABULARY))
    assert report.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and report.count() == len(rows)
    assert report.agg(F.sum("n_tokens")).first()[0] == sum(map(len, got.values()))
    assert wb.round_trip_report(docs.limit(0), vocab_path(WORD_VOCABULARY)).count() == 0


def test_query_equals_the_library_on_the_whole_table(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_tree_bpe"](spark, SF).collect()}
    for r, e in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        text = library.decode(e.ids, skip_special_tokens=False)
        assert got[r.doc_id] == (r.doc_id, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest())
