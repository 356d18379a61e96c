"""PartEnum join against brute force on sets."""

from __future__ import annotations

import random
import re

import numpy as np

from tsuji.llm import partenum as pe
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_AZ))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(map(tuple, pe.near_duplicates(df, **kw).collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op4_partenum"](spark, SF).collect())) == brute(rows)


def test_pairs_at_the_threshold_and_families(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(5000)]
    rows, n = [], 0

    def add(words, sep=" "):
        nonlocal n
        rows.append((n, sep.join(words)))
        n += 1

    passage = [rng.choice(vocab) for _ in range(60)]
    for size in list(range(1, 40)) + [55, 80, 120, 200, 300, 700]:
        base = [rng.choice(vocab) for _ in range(size)]
        add(base)
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randint(0, max(1, size // 22))):
                kind, at = rng.random(), rng.randrange(len(w))
                if kind < .5:
                    w[at] = rng.choice(vocab)
                elif kind < .75 and len(w) > 1:
                    del w[at]
                else:
                    w.insert(at, rng.choice(vocab))
            add([x.upper() for x in w] if rng.random() < .3 else w, rng.choice([" ", "\n", " \t "]))
        cut = max(1, size // rng.randint(9, 11))
        add(base[cut:])                                    # subsets around the threshold
        add(base[:size - cut])
    for _ in range(60):                                    # passage sharers, mostly not linked
        add([rng.choice(vocab) for _ in range(rng.randint(10, 90))] + passage)
    rng.shuffle(rows)
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_every_joinable_pair_shares_a_kept_signature():
    """The signature guarantee itself, at the widest allowed difference."""
    rng = np.random.default_rng(2)
    for n in [4, 5, 8, 10, 13, 20, 33, 60, 100, 170, 400, 900]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            m = len(a)
            lost = int(rng.integers(0, m // 9 + 1))
            keep = rng.permutation(a)[:m - lost]
            more = 0
            while 100 * len(keep) >= 80 * (m + more + 1):
                more += 1
            more = int(rng.integers(0, more + 1)) if rng.random() < .5 else more
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, more, dtype=np.uint64) * np.uint64(2)]))
            if 100 * len(keep) < 80 * (m + len(b) - len(keep)):
                continue
            small, big = (a, b) if len(a) <= len(b) else (b, a)
            t = int(np.searchsorted(pe.bands(), len(big), "right")) - 1
            sa, sb = (set(pe.signatures(s, pe.running(s), t)[0].tolist()) for s in (small, big))
            assert sa & sb, (n, len(a), len(b))
            x, y = (np.frombuffer(pe.sketch(s, pe.running(s), t), np.uint8) for s in (small, big))
            assert pe.could_link(len(a), x[None], np.array([len(b)]), y[None], 80).all()


def test_packing_round_trip():
    rng = np.random.default_rng(4)
    key = np.sort(rng.integers(0, 1 << 48, 500, dtype=np.uint64))
    ref = rng.integers(0, 2 * 70, 500).astype(np.int32)
    cls, size = rng.integers(-2 ** 62, 2 ** 62, 70), rng.integers(0, 90, 70)
    k, own, c, s = pe.unpack(pe.pack(key, ref, cls, size))
    assert (k == key).all() and (own == (ref & 1)).all() and (c == cls[ref >> 1]).all() and (s == size[ref >> 1]).all()


def test_nulls_repeats_empty_table(spark):
    rows = [(5, "a b"), (3, "A  b"), (4, None), (7, " \n"), (8, ""), (9, "a b c"), (9, "a b c"), (2, "x " * 30000), (1, "x " * 20000), (None, "a b")]
    got = run(spark, rows)
    assert (5, 1, 3) in got and (3, 1, 3) in got and (4, 0, 4) in got and (7, 0, 7) in got and (8, 0, 8) in got
    assert got.count((9, 1, 9)) == 2 and (2, 1, 1) in got and (None, 1, 3) in got
    df = spark.createDataFrame([], "doc_id long, text string, cls string")
    assert pe.near_duplicates(df).collect() == []


def test_bands_of_very_long_texts(spark):
    """Sets beyond band 59 pass the thinning and get their band."""
    tags = [3, 52, 53, 59, 60, 61, 86]
    rows = [(1, None, None, 10 * t + c, 1000 + t, t, 0, True, 2) for t in tags for c in (1, 2)]
    found = spark.createDataFrame(rows, "kind int, id long, n long, cls long, sig long, tag int, part int, own boolean, freq long")
    got = {r.tag for r in pe.thinned(found.withColumn("spent", pe.F.lit(0)), 80).collect()}
    assert got == {3, 53, 59, 60, 61, 86}                  # band 52 may drop parts, 3 and those from 53 on none
    sizes = [1, 4, 5, 1_753_496, 1_753_497, 2_191_871, 2_191_872, 2_739_841, 1 << 29]
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    assert [r.b for r in df.select(pe.band_of(pe.F.col("n"), 80).alias("b")).collect()] == [
        int(np.searchsorted(pe.bands(), n, "right")) - 1 for n in sizes]


def test_spare_parts_are_spent_once(spark):
    """A pair keeps a common signature after both leaving-outs, whatever the frequencies."""
    rng = np.random.default_rng(4)
    rows, pairs = [], []
    for n in [30, 40, 60, 74, 90, 110, 150, 200]:
        for _ in range(60):
            t = int(np.searchsorted(pe.bands(), n, "right")) - 1
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            more = len(a) // 9
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[more:]], rng.integers(0, 1 << 63, more, dtype=np.uint64) * np.uint64(2)]))
            x, y = (pe.signatures(s, pe.running(s), t) for s in (a, b))
            assert 0 <= x[2] <= pe.scheme(t).spare and len(x) == 3
            common = sorted(set(x[0].tolist()) & set(y[0].tolist()))
            part = dict(zip(x[0].tolist(), x[1].tolist()))
            name, c = len(pairs), 2 * len(pairs)
            pairs.append(name)
            for i, sig in enumerate(common):
                for k, s in ((0, x), (1, y)):
                    rows.append((1, None, None, c + k, int(np.uint64(sig).view(np.int64)), t, int(part[sig]), True, 2 + i, int(s[2])))
    schema = "kind int, id long, n long, cls long, sig long, tag int, part int, own boolean, freq long, spent int"
    got = {r.cls // 2 for r in pe.thinned(spark.createDataFrame(rows, schema), 80).select("cls").collect()}
    assert got == set(pairs)


def test_spent_parts_travel_with_the_signatures():
    key, ref = np.array([3, 5, 9], np.uint64), np.array([1, 4, 5], np.int32)
    blob = pe.pack(key, ref, np.array([7, 8, 9]), np.array([1, 2, 3], np.uint8), np.array([10, 11, 20, 21, 30, 31], np.uint16))
    assert pe.unpack_spent(blob).tolist() == [11, 30, 31]
    assert [x.tolist() for x in pe.unpack(blob)] == [[3, 5, 9], [True, False, True], [7, 9, 9], [1, 3, 3]]


def test_documents_without_an_id_link(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(words)), (7, " ".join(words[:57])), (3, " ".join(words[3:])), (9, "quite another text of a few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in pe.near_duplicates(df).collect()}
    assert got == {(None, 3), (7, 3), (3, 3), (9, 9)}


def test_near_copies_of_a_long_text(spark):
    """128,000 words: the time grows with the length, and one word in 200 may differ."""
    rng = random.Random(6)
    a = [f"w{rng.randrange(10 ** 7)}" for _ in range(128_000)]
    b, c = list(a), list(a)
    for _ in range(640):
        b[rng.randrange(len(b))] = "x"
    for _ in range(12_800):
        c[rng.randrange(len(c))] = "y"                       # too many for 80 percent of the shingles
    docs = spark.createDataFrame([(5, " ".join(a)), (3, " ".join(b)), (4, " ".join(c)), (9, "short text")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in pe.near_duplicates(docs).collect()}
    assert got == {5: 3, 3: 3, 4: 4, 9: 9}
