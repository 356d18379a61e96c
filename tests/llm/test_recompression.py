"""Periodic runs: grammar extensions and reports against plain loops."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tsuji.llm import recompression as rc
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(w):
    """(start, length, period) of every run, by comparing all words of every distance."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1 if j == i else j
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in dropped).encode()).hexdigest())


def periodic_words(rnd, letters):
    w = [rnd.randrange(letters) for _ in range(rnd.randrange(0, 120))]
    for _ in range(rnd.randrange(4)):
        cycle = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 9))]
        if rnd.random() < 0.3:
            cycle += cycle[:rnd.randrange(len(cycle) + 1)]
        at = rnd.randrange(len(w) + 1)
        w[at:at] = (cycle * 12)[:rnd.randrange(3 * len(cycle), 7 * len(cycle) + 1)]
    return w


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_equal_plain_loops(letters):
    rnd = random.Random(letters)
    for _ in range(60):
        texts = [periodic_words(rnd, letters) for _ in range(rnd.randrange(1, 8))]
        got = rc.runs_of([[str(x).encode() for x in w] for w in texts])
        for w, (s, m, q) in zip(texts, got):
            assert list(zip(s, m, q)) == plain_runs(w)


def test_nested_powers_and_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a                                   # fibonacci words: many overlapping repetitions
    nested = (([1, 2] * 5 + [3]) * 6 + [4]) * 5
    for w in (b, nested, [7] * 500, [7] * 5, [7] * 6, [1, 2] * 4, [1, 2] * 3 + [1]):
        (s, m, q), = rc.runs_of([[str(x).encode() for x in w]])
        assert list(zip(s, m, q)) == plain_runs(w)


def test_extensions_equal_plain_comparison():
    rnd = random.Random(9)
    for _ in range(40):
        texts = [w for w in (periodic_words(rnd, rnd.choice([1, 2, 4])) for _ in range(4)) if w]
        laid, fence = [0], [True]
        for w in texts:
            laid += [*w, 0]
            fence += [False] * len(w) + [True]
        g = rc.Grammar(np.array(laid), np.array(fence))
        same = [(laid[x], x if fence[x] else -1) for x in range(len(laid))]
        inner = [x for x in range(len(laid)) if not fence[x]]
        pairs = [sorted(rnd.sample(inner, 2)) for _ in range(80)] if len(inner) > 1 else []
        for (i, j), f, r in zip(pairs, *(g.common(*np.array(pairs).T, d) for d in (True, False))) if pairs else ():
            k = 0
            while same[i + k] == same[j + k]:
                k += 1
            assert f == k
            k = 0
            while same[i - 1 - k] == same[j - 1 - k]:
                k += 1
            assert r == k
        assert len(g.rounds[-1].symbol) == 2 * len(texts) + 1    # every text is one symbol


def test_long_periodic_text():
    n = 300_000
    cycle = [str(i % 977).encode() for i in range(n // 6)]
    (s, m, q), = rc.runs_of([[b"x"] + cycle * 6 + [b"y"]])
    assert (1, 6 * len(cycle), 977) not in list(zip(s, m, q)) and len(s) >= 1
    (s, m, q), = rc.runs_of([[b"w"] * n])
    assert (s, m, q) == ([0], [n], [1])


def test_report_equals_plain_report(spark):
    rnd = random.Random(4)
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:30] + list(range(5)) + [None, -10, 7, 7]
    texts = ["", None, "a", " \t\n", "a b " * 9, "é ü é ü " * 6, "x\x0by\x0c" * 8]
    rows = [(i, rnd.choice(texts) if rnd.random() < 0.4 else " ".join(map(str, periodic_words(rnd, 3)))) for i in ids]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, n_runs int, start string")
    got = sorted((tuple(r) for r in rc.run_report(docs).collect()), key=repr)
    assert got == sorted(((i, *plain_report(i, t)) for i, t in rows), key=repr)
    assert any(r[1] for r in got)
    assert rc.run_report(docs.limit(0)).count() == 0


def test_query_equals_plain_report_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_runs"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        if len(r.text or "") < 12_000:                    # the plain loops take the square of a text's length
            assert got[r.doc_id] == plain_report(r.doc_id, r.text)
