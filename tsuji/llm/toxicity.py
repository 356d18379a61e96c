"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters and digits inside words to one plain form (so that
``1d10t`` and Cyrillic look-alikes meet ``idiot``) and turns everything else into single spaces.
Lexicon entries are whole words or word beginnings with their boundary blanks; exception phrases are
entries that cancel the hits inside them. A document's weight is the sum of its surviving hits; the
score is a logistic curve over the weight and the weight per thousand words.

The lexicon, its exceptions and the curve are learned from labelled rows (``learn``): a bounded
sample (``max_rows``, smallest hash first) gives document counts per word and word beginning.
Entries are chosen greedily by the toxic documents they help to explain, until every document is
explained ``COVER`` times; words that merely come along in copies of a toxic document are kept out
because their neighbouring words are always the same. An entry must help a 60th of the toxic documents (three
at least), so there are at most 60 * ``COVER`` of them; nothing else limits the lexicon, its candidates
or its exceptions, which all come from the sample.

Defined cases: null, empty or letterless text has weight 0; without usable labels the lexicon is
empty and all scores are 0; repeated rows score alike; other columns pass through.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_schema, map_pieces, prepared, with_columns, written

# look-alikes (fixed values): letters of other scripts, then digits and signs used as letters
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ї": "i", "ѕ": "s", "ј": "j",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ո": "n", "հ": "h",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ſ": "s",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
SAME = {"l": "i"}               # 1 stands for i and for l: both become i

MAX_TRAIN_ROWS = 8000           # labelled rows the model is fitted on (documented bound)
PREFIXES = (4, 5, 6, 7, 8, 9)
COVER = 5                       # entries after which a toxic document counts as explained
OWN_CONTEXTS = 0.5              # least share of an entry's toxic documents with neighbours of their own


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded code point, 0 where not a letter; value of a digit or sign used as a letter; digit flag)."""
    letter = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            low = low[0] if low else ch
            low = LOOK_ALIKES.get(low, low)
            if 0xFF41 <= ord(low) <= 0xFF5A:                     # full-width letters
                low = chr(ord(low) - 0xFF41 + 0x61)
            letter[c] = ord(SAME.get(low, low))
    sub = np.zeros(0x110000, np.uint32)
    for k, v in {**DIGITS, **SIGNS}.items():
        sub[ord(k)] = ord(SAME.get(v, v))
    sign = np.zeros(0x110000, bool)
    sign[[ord(c) for c in SIGNS]] = True
    return letter, sub, sign


def fold(texts: list[str]) -> list[str]:
    """Folded texts: words of letters between single blanks, one blank at either end.
    A digit counts as a letter when a letter stands beside it, or beyond one other digit; a sign
    only between two letters, or (but for ``!``) before one."""
    joined = " ".join(texts)
    if not joined:
        return [" " for _ in texts]
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    letter, sub, sign = _tables()
    out = letter[cps]
    subs = np.flatnonzero(sub[cps])
    if len(subs):
        padded = np.concatenate([[0, 0], out, [0, 0]])
        near = (padded[subs + 1] > 0, padded[subs + 3] > 0)
        plain = np.concatenate([[0], sub[cps], [0]])                    # a digit between the digit and the letter
        far = ((padded[subs] > 0) & (plain[subs] > 0), (padded[subs + 4] > 0) & (plain[subs + 2] > 0))
        digit = ~sign[cps[subs]]
        use = np.where(digit, near[0] | near[1] | far[0] | far[1], near[1] & (near[0] | (cps[subs] != ord("!"))))
        out = out.copy()
        out[subs[use]] = sub[cps[subs[use]]]
    blank = out == 0
    out[blank] = 0x20
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1   # the joining blanks
    keep = np.ones(len(out), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    kept_upto = np.concatenate([[0], np.cumsum(keep)])
    flat = out[keep].tobytes().decode("utf-32-le")
    stops = kept_upto[np.minimum(ends, len(out))].tolist()
    res, a = [], 0
    for b in stops:
        t = flat[a:b].strip(" ")
        res.append(f" {t} " if t else " ")
        a = b
    return res


@dataclass(frozen=True)
class Model:
    entries: tuple = ()                              # (folded pattern, weight) pairs
    exceptions: tuple = ()                           # folded phrases that cancel hits inside them
    curve: tuple = (0.0, 0.0, 0.0)                   # intercept, weight, weight per 1000 words


@lru_cache(maxsize=4)
def _automaton(entries: tuple, exceptions: tuple):
    import ahocorasick

    a = ahocorasick.Automaton()
    for p, w in entries:
        a.add_word(p, (len(p), w))
    for p in exceptions:
        a.add_word(p, (len(p), None))
    a.make_automaton()
    return a


def hits(model: Model, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the hits that no exception phrase covers."""
    if not model.entries:
        return []
    found = [(e + 1 - n, e + 1, w) for e, (n, w) in _automaton(model.entries, model.exceptions).iter(folded)]
    spared = [(a, b) for a, b, w in found if w is None]
    out = [x for x in found if x[2] is not None]
    if spared:
        out = [x for x in out if not any(a <= x[0] and x[1] <= b for a, b in spared)]
    return out


def weight_and_words(model: Model, folded: list[str]) -> tuple[np.ndarray, np.ndarray]:
    w = np.zeros(len(folded))
    if model.entries:
        scan = _automaton(model.entries, model.exceptions).iter
        for i, t in enumerate(folded):
            if next(scan(t), None) is not None:
                w[i] = sum(x[2] for x in hits(model, t))
    return w, np.array([t.count(" ") for t in folded], float)


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(1000 * weight / np.maximum(words, 1))], 1)


def score(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity",
          weight_col: str = "toxic_weight") -> DataFrame:
    """Adds the score (0 to 1) and the summed weight of the hits of every whole text."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        w, n = weight_and_words(model, fold([t or "" for t in piece.column(text_col).to_pylist()]))
        s = 1 / (1 + np.exp(-(features(w, n) @ np.array(model.curve)))) if model.entries else np.zeros(len(w))
        return with_columns(piece, {out_col: pa.array(s, pa.float64()), weight_col: pa.array(w, pa.float64())})

    schema = add_schema(df, **{out_col: T.DoubleType(), weight_col: T.DoubleType()})
    return prepared(df).mapInArrow(map_pieces(run, text_col), schema)


def _terms(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3:
            out.add(f" {w} ")
            for k in PREFIXES:
                if len(w) > k:
                    out.add(f" {w[:k]}")
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge; deterministic."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - y) / len(y) + l2 * b
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b = b - step
        if np.abs(step).max() < 1e-8:
            break
    return b


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id",
                  max_rows: int = MAX_TRAIN_ROWS, keep=None) -> DataFrame:
    """``docs`` columns plus ``_label`` for at most ``max_rows`` labelled ids, smallest hash first;
    one label per id (the larger one where they disagree), one row per id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if keep is not None:
        known = known.where(keep(F.col(id_col)))
    known = (known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    return docs.join(F.broadcast(known), F.col(id_col) == F.col("_id")).drop("_id")   # bounded by max_rows


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS, keep=None) -> Model:
    """Fit lexicon, exceptions and curve. ``keep(id column)`` limits the labels that may be used."""
    rows = training_rows(docs, labels, label_col, id_col, max_rows, keep).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), "_label")
    rows = written(rows, "toxicity-rows")                         # read five times below

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            folded = fold([t or "" for t in batch.column("text").to_pylist()])
            for t, y in zip(folded, batch.column("_label").to_pylist()):
                for term in _terms(t):
                    seen[term, y] += 1
                if len(seen) > 300_000:
                    yield _counted(seen)
                    seen = Counter()
        yield _counted(seen)

    per_term = (prepared(rows).mapInArrow(count, "term string, toxic long, clean long")
                .groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")))
    n_toxic, n_clean = rows.drop("text").agg(F.count_if(F.expr("_label = 1")), F.count_if(F.expr("_label = 0"))).first()
    if not n_toxic or not n_clean:
        return Model()
    # mostly in toxic documents, and in enough of them; the greedy choice below does the rest
    least = max(3, n_toxic // 60)
    good = (per_term.where((F.col("t") >= least) & (F.col("c") / n_clean <= 0.1 * F.col("t") / n_toxic))
            .orderBy(F.desc("t"), "term").collect())              # terms of at most max_rows texts
    if not good:
        return Model()
    cand = {r.term: (r.t, r.c) for r in good}

    def hit_terms(batches):
        for batch in batches:
            folded = fold([t or "" for t in batch.column("text").to_pylist()])
            found = [_in_context(t, cand) if y else [] for t, y in zip(folded, batch.column("_label").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("_label"), pa.array(found, pa.list_(pa.string())),
                                              pa.array(folded)], names=["label", "terms", "folded"])

    toxic_hits = prepared(rows).mapInArrow(hit_terms, "label int, terms array<string>, folded string")
    found = [r.terms for r in toxic_hits.where("label = 1").select("terms").collect()]   # at most max_rows lists
    chosen = _greedy(found, cand, n_toxic, n_clean, least)
    if not chosen:
        return Model()
    weights = tuple((p, float(np.log((cand[p][0] + .5) / (n_toxic + 1)) - np.log((cand[p][1] + .5) / (n_clean + 1))))
                    for p in sorted(chosen))
    exceptions = _exceptions(toxic_hits, chosen)
    model = Model(weights, exceptions)
    sample = _fit_rows(rows, model)
    x = features(sample[:, 0], sample[:, 1])
    return Model(weights, exceptions, tuple(fit_logistic(x, sample[:, 2]).tolist()))


def _counted(seen: Counter) -> pa.RecordBatch:
    both: dict[str, list[int]] = {}
    for (term, y), n in seen.items():
        both.setdefault(term, [0, 0])[0 if y else 1] += n
    return pa.RecordBatch.from_arrays(
        [pa.array(list(both), pa.string()), pa.array([v[0] for v in both.values()], pa.int64()),
         pa.array([v[1] for v in both.values()], pa.int64())], names=["term", "toxic", "clean"])


def _in_context(folded: str, cand: dict) -> list[str]:
    """``previous word, word, next word, term`` of every candidate in a text."""
    words = ["", *folded.split(), ""]
    out = set()
    for i in range(1, len(words) - 1):
        for term in _terms(words[i]):
            if term in cand:
                out.add(f"{words[i - 1]},{words[i]},{words[i + 1]},{term}")
    return sorted(out)


def _greedy(docs: list[list[str]], cand: dict, n_toxic: int, n_clean: int, least: int) -> list[str]:
    """Entries in the order of how many not yet explained toxic documents each one helps to explain;
    clean documents count against an entry, a longer entry wins a tie."""
    contexts: dict[str, set] = {}
    terms = []
    for d in docs:
        mine = set()
        for c in d:
            around, _, term = c.rpartition(",")
            contexts.setdefault(term, set()).add(around)
            mine.add(term)
        terms.append(mine)
    support = Counter(t for d in terms for t in d)
    allowed = {t for t in support if len(contexts[t]) >= OWN_CONTEXTS * support[t]}
    open_docs, chosen = [[d & allowed, COVER] for d in terms], []
    while True:
        gain = Counter(t for d, left in open_docs if left for t in d)
        if not gain:
            break
        best = max(gain, key=lambda t: (gain[t] - 5 * cand[t][1] * n_toxic / n_clean, len(t), t))
        if gain[best] < least:
            break
        chosen.append(best)
        for d in open_docs:
            if best in d[0]:
                # what only repeats the entry (a part or an extension of it) explains nothing more
                d[0] = {t for t in d[0] if not (t.startswith(best.rstrip()) or best.startswith(t.rstrip()))}
                d[1] = max(0, d[1] - 1)
    return chosen


def _exceptions(rows: DataFrame, chosen: list[str], least: int = 3) -> tuple:
    """Two-word phrases around a hit that clean documents repeat and toxic ones never have."""
    bare = Model(tuple((p, 1.0) for p in sorted(chosen)))

    def phrases(batches):
        for batch in batches:
            out, labels = [], []
            for t, y in zip(batch.column("folded").to_pylist(), batch.column("label").to_pylist()):
                mine = set()
                for a, b, _ in hits(bare, t):
                    b = t.index(" ", a + 1)
                    after = t.find(" ", b + 1)
                    before = t.rfind(" ", 0, a)
                    if after > 0:
                        mine.add(t[a:after + 1])
                    if before >= 0:
                        mine.add(t[before:b + 1])
                out += mine
                labels += [y] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(labels, pa.int32())], names=["phrase", "label"])

    seen = (rows.mapInArrow(phrases, "phrase string, label int").groupBy("phrase")
            .agg(F.count_if(F.expr("label = 0")).alias("c"), F.count_if(F.expr("label = 1")).alias("t"))
            .where((F.col("c") >= least) & (F.col("t") == 0)).orderBy(F.desc("c"), "phrase"))
    return tuple(r.phrase for r in seen.collect())


def _fit_rows(rows: DataFrame, model: Model) -> np.ndarray:
    def run(batches):
        for batch in batches:
            w, n = weight_and_words(model, fold([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(n), batch.column("_label").cast(pa.float64())],
                                             names=["w", "n", "y"])

    got = rows.mapInArrow(run, "w double, n double, y double").orderBy("w", "n", "y").collect()   # max_rows triples
    return np.array([tuple(r) for r in got])


def not_held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 != 1


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    model = learn(docs, labels, keep=not_held_out)
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(~not_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      F.col("toxicity").alias("score"),
                      F.when(F.col("toxicity") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
