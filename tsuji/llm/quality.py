"""Quality classifier by co-training two views of a document.

The text view sees only the text (character classes, repetition, vocabulary), the metadata view only
the record around it (source, language, recorded length). Both are logistic models. In every round
each view labels unlabelled documents; those it is most confident of are added, with that label, to
the training rows of the other view. A held-back part of the labelled rows then calibrates each view
and weighs them into one score for every document.

The features of all documents, a few numbers each, are written once. Fitting uses a bounded sample of the
labelled ones (``max_rows``, smallest hash first). In every round both views are applied to all unlabelled
documents: every task keeps the most confident ones of its rows, the lists are merged, and only the
``per_round`` best, without repeats of equal features, join the training rows. Feature rows - not texts - come
to the driver. Scoring is one pass over all documents.

Defined cases: null text counts as empty; null source, language or length are values of their own;
an unlabelled corpus or one with a single class scores everything 1 (nothing is rejected); repeated
rows score alike; of an id with several texts the row of smallest content hash is the labelled one; extra
columns pass through, columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_schema, map_pieces, prepared, utf8, with_columns, written
from .shingles import words

MAX_ROWS = 6000                # labelled documents fitted on (documented bound)
PER_ROUND = 300                # documents each view may label in a round, the best of all unlabelled ones
ROUNDS = 4
CONFIDENT = 0.9
THRESHOLD = 0.5                # documents that score less are rejected
BUCKETS = 24                   # hashed source values


def _bytes(s: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(s)] = True
    return t


_UPPER = _bytes(bytes(range(65, 91)))
_LETTER = _UPPER | _bytes(bytes(range(97, 123)))
_LETTER[128:] = True
_DIGIT = _bytes(b"0123456789")
_BLANK = _bytes(b" \t\n\r\x0b\x0c")
_STOP = _bytes(b".,;:'\"-()")
_MARK = ~(_LETTER | _DIGIT | _BLANK | _STOP)
_CLASSES = (_UPPER, _LETTER, _DIGIT, _STOP, _MARK, _bytes(b"!?"), _bytes(b"|<>{}[]=\\/"), _bytes(b"\n"))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    upto = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=upto[1:])
    return upto[bounds[1:]] - upto[bounds[:-1]]


def text_numbers(arr: pa.Array) -> np.ndarray:
    """What the text view knows of each text."""
    raw, off = utf8(arr)
    size = np.maximum(np.diff(off), 1)
    counts = [_sums(c[raw], off) for c in _CLASSES]
    h, first = words(raw, off)
    n_words = np.diff(first)
    n = np.maximum(n_words, 1)
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    starts = first[:-1][n_words > 0]
    same[starts] = False
    distinct, lines_twice, top = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    for i in np.flatnonzero(n_words).tolist():
        s = np.sort(h[first[i]:first[i + 1]])
        edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
        distinct[i], top[i] = len(edge) - 1, np.diff(edge).max()
        if counts[-1][i]:
            lines = [x for x in raw[off[i]:off[i + 1]].tobytes().split(b"\n") if x]
            lines_twice[i] = 1 - len(set(lines)) / max(1, len(lines))
    log_n = np.log1p(n_words)
    return np.stack([counts[0] / np.maximum(counts[1], 1), *[c / size for c in counts[1:]], np.log1p(size), log_n,
                     size / n / 10, distinct / n, np.log1p(distinct) / np.maximum(log_n, 1), _sums(same, first) / n,
                     top / n, lines_twice], 1)


def text_features(x: np.ndarray) -> np.ndarray:
    """Features from ``text_numbers``."""
    return np.column_stack([x, x ** 2, np.minimum(x, 0.05)])


def meta_features(source: list, lang: list, length: np.ndarray) -> np.ndarray:
    n = len(source)
    x = np.zeros((n, BUCKETS + 12))
    bucket = lambda v, m: m - 1 if v is None else zlib.crc32(str(v).encode()) % (m - 1)
    for i in range(n):
        x[i, bucket(source[i], BUCKETS)] = 1
        x[i, BUCKETS + bucket(lang[i], 8)] = 1
    known = ~np.isnan(length)
    log_n = np.log1p(np.where(known, length, 0).clip(0))
    x[:, BUCKETS + 8:] = np.stack([~known, log_n, log_n ** 2 / 10, np.minimum(log_n, 4)], 1)
    return x


@dataclass(frozen=True)
class View:
    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray          # last one: intercept

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weight[:-1] + self.weight[-1]


@dataclass(frozen=True)
class Model:
    text: View | None = None
    meta: View | None = None
    blend: tuple = ()           # weights of the calibrated views and intercept
    calibration: tuple = ()     # (slope, intercept) of each view


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, l2: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weighted ridge logistic regression by damped Newton steps; last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.ones(len(x)) if w is None else w
    w = w / w.sum()
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ b)
        g = x.T @ (w * (p - y)) + ridge * b
        h = (x * (w * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        b = b - step
        if np.abs(step).max() < 1e-7:
            break
    return b


def fit_view(x: np.ndarray, y: np.ndarray) -> View:
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - mean) / spread, -8, 8)
    balance = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))   # rare junk counts as much
    return View(mean, spread, logistic(z, y, balance))


class ArrayPool:
    """Unlabelled rows held in memory."""

    def __init__(self, pt: np.ndarray, pm: np.ndarray):
        self.rows = (pt, pm)

    def best(self, views: list[View], wanted: dict[tuple[int, int], int]) -> dict[tuple[int, int], list[tuple]]:
        """Per (view, label) the ``wanted`` number of (key, text features, metadata features) the view is most
        confident of, best first."""
        out = {}
        for (k, label), most in wanted.items():
            margin = views[k].margin(self.rows[k]) * (1 if label else -1)
            at = np.argsort(-margin, kind="stable")[:most]
            out[k, label] = [(int(i), self.rows[0][i], self.rows[1][i]) for i in at if sigmoid(margin[i:i + 1])[0] >= CONFIDENT]
        return out


class TablePool:
    """Unlabelled documents as a table of ``_features``: every round looks at all of them."""

    def __init__(self, table: DataFrame):
        self.table = table

    def best(self, views: list[View], wanted: dict[tuple[int, int], int]) -> dict[tuple[int, int], list[tuple]]:
        limit = float(np.log(CONFIDENT / (1 - CONFIDENT)))
        names = ("view", "label", "margin", "key", "x", "source", "lang", "length")

        def run(batches):
            for batch in batches:
                x = _numbers(batch)
                features = text_features(x), _meta(batch, "source", "lang", "length")
                key = batch.column("key").to_numpy()
                for (k, label), most in wanted.items():
                    margin = np.round(views[k].margin(features[k]) * (1 if label else -1), 9)
                    _, at = np.unique(key, return_index=True)              # equal documents teach no more than one
                    at = at[margin[at] >= limit]
                    at = at[np.lexsort((key[at], -margin[at]))][:most]
                    part = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), k, np.int32)), pa.array(np.full(len(at), label, np.int32)), pa.array(margin[at]),
                         *(part.column(c) for c in names[3:])], names=names)

        schema = T.StructType([T.StructField("view", T.IntegerType()), T.StructField("label", T.IntegerType()), T.StructField("margin", T.DoubleType()),
                               *(self.table.schema[c] for c in names[3:])])
        most = F.create_map(*[F.lit(v) for (k, label), n in wanted.items() for v in (2 * k + label, n)])
        rank = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc("margin"), "key"))
        found = (prepared(self.table.select(*names[3:])).mapInArrow(run, schema).dropDuplicates(["view", "label", "key"])
                 .withColumn("rank", rank).where(F.col("rank") <= max(wanted.values()))
                 .where(F.col("rank") <= most[2 * F.col("view") + F.col("label")]).toArrow())
        out: dict[tuple[int, int], list[tuple]] = {w: [] for w in wanted}
        if found.num_rows:
            order = np.argsort(found.column("rank").to_numpy(), kind="stable")
            found = found.take(pa.array(order)).combine_chunks()
            batch = found.to_batches()[0]
            t, m = text_features(_numbers(batch)), _meta(batch, "source", "lang", "length")
            for i, (k, label, key) in enumerate(zip(*(found.column(c).to_pylist() for c in ("view", "label", "key")))):
                out[k, label].append((key, t[i], m[i]))
        return out


def co_train(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pt: np.ndarray | None = None, pm: np.ndarray | None = None,
             rounds: int = ROUNDS, pool=None, per_round: int | None = None) -> Model:
    """``xt, xm, y``: labelled rows of both views; the unlabelled ones are ``pt, pm`` or a ``pool``, of which
    each view may label ``per_round`` in a round."""
    if len(y) < 10 or y.min() == y.max():
        return Model()
    pool = pool or ArrayPool(pt, pm)
    per_round = per_round if per_round is not None else int(0.05 * len(pt))
    hold = np.arange(len(y)) % 4 == 3                      # rows come in hash order
    if y[hold].min() == y[hold].max() or y[~hold].min() == y[~hold].max():
        hold = np.zeros(len(y), bool)
    fit = ~hold
    views = (xt, xm)
    given: list[dict] = [{}, {}]                           # pseudo-labelled rows each view was given, by key
    trained = [fit_view(v[fit], y[fit]) for v in views]
    share = y[fit].mean()
    quota = {1: round(per_round * share), 0: round(per_round * (1 - share))}
    for _ in range(rounds if per_round else 0):
        wanted = {(k, label): q + len(given[1 - k]) for k in (0, 1) for label, q in quota.items() if q}
        new = [dict(g) for g in given]
        for (k, label), rows in pool.best(trained, wanted).items():
            left = quota[label]
            for key, t, m in rows:
                if left and key not in new[1 - k]:
                    new[1 - k][key] = (label, t, m)
                    left -= 1
        if all(n.keys() == g.keys() for n, g in zip(new, given)):
            break
        given = new
        for k in (0, 1):
            rows = [given[k][key] for key in sorted(given[k])]
            x = np.concatenate([views[k][fit], [r[1 + k] for r in rows]]) if rows else views[k][fit]
            trained[k] = fit_view(x, np.concatenate([y[fit], [r[0] for r in rows]]))
    judge = hold if hold.any() else fit
    margins = [np.clip(trained[k].margin(views[k][judge]), -30, 30) for k in (0, 1)]
    slopes = [logistic(m[:, None], y[judge], l2=1e-4) for m in margins]
    calibrated = np.stack([s[0] * m + s[1] for s, m in zip(slopes, margins)], 1)
    blend = logistic(calibrated, y[judge], l2=1e-3)
    return Model(trained[0], trained[1], tuple(blend.tolist()), tuple((float(s[0]), float(s[1])) for s in slopes))


def view_scores(model: Model, batch: pa.RecordBatch, text_col: str, source_col: str, lang_col: str, length_col: str):
    """(text, metadata, combined) scores of a batch."""
    if model.text is None:
        one = np.ones(batch.num_rows)
        return one, one, one
    z = [model.text.margin(text_features(text_numbers(batch.column(text_col)))),
         model.meta.margin(_meta(batch, source_col, lang_col, length_col))]
    z = np.stack([a * np.clip(v, -30, 30) + b for (a, b), v in zip(model.calibration, z)], 1)
    both = z @ np.array(model.blend[:2]) + model.blend[2]
    return sigmoid(z[:, 0]), sigmoid(z[:, 1]), sigmoid(both)


def _meta(batch: pa.RecordBatch, source_col: str, lang_col: str, length_col: str) -> np.ndarray:
    length = batch.column(length_col).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return meta_features(batch.column(source_col).to_pylist(), batch.column(lang_col).to_pylist(), length)


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))


def _features(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, length_col: str) -> DataFrame:
    """``_id, key, x, source, lang, length`` of every document; ``key`` names its features."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"),
                       F.col(lang_col).alias("lang"), F.col(length_col).cast("double").alias("length"))

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = text_numbers(piece.column("text"))
        record = zip(x, *(piece.column(c).to_pylist() for c in ("source", "lang", "length")))
        key = [int.from_bytes(hashlib.blake2b(a.tobytes() + repr(rest).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
               for a, *rest in record]
        return pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(key, pa.int64()), pa.array(list(x), pa.list_(pa.float64())),
                                           *(piece.column(c) for c in ("source", "lang", "length"))], names=schema.names)

    schema = T.StructType([rows.schema["_id"], T.StructField("key", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType())),
                           *(rows.schema[c] for c in ("source", "lang", "length"))])
    return prepared(rows).mapInArrow(map_pieces(run, "text"), schema)


def score(df: DataFrame, model: Model, text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
          length_col: str = "n_chars", prefix: str = "quality") -> DataFrame:
    """Adds ``{prefix}``, ``{prefix}_text`` and ``{prefix}_meta``: the chance that a document is good."""
    names = (f"{prefix}_text", f"{prefix}_meta", prefix)

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        got = view_scores(model, piece, text_col, source_col, lang_col, length_col)
        return with_columns(piece, {n: pa.array(v, pa.float64()) for n, v in zip(names, got)})

    schema = add_schema(df, **{n: T.DoubleType() for n in names})
    return prepared(df).mapInArrow(map_pieces(run, text_col), schema)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", length_col: str = "n_chars", label_col: str = "quality",
          max_rows: int = MAX_ROWS, per_round: int = PER_ROUND, rounds: int = ROUNDS) -> Model:
    """Fit on labelled documents (1 = good; the smaller label where an id has several) and, round by round,
    on what the views label among all the others."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("double").alias("_label")))
    table = written(_features(docs, id_col, text_col, source_col, lang_col, length_col).join(known, "_id", "left"), "quality-features")
    body = ("x", "source", "lang", "length")
    one = (table.where(F.col("_label").isNotNull()).groupBy("_id", "_label").agg(F.min(F.struct("key", *body)).alias("r"))
           .orderBy(F.xxhash64("_id"), F.col("_id")).limit(max_rows).select("_label", *[F.col("r")[c].alias(c) for c in body]).toArrow())
    if not one.num_rows:
        return Model()
    batch = one.combine_chunks().to_batches()[0]
    return co_train(text_features(_numbers(batch)), _meta(batch, *body[1:]), batch.column("_label").to_numpy(),
                    pool=TablePool(table.where(F.col("_label").isNull()).drop("_id", "_label")), per_round=per_round, rounds=rounds)


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    out = score(docs.select("doc_id", "text", "source", "lang", "n_chars"), learn(docs, labels))
    return out.select("doc_id", F.col("quality").alias("score"), F.col("quality_text").alias("text_score"),
                      F.col("quality_meta").alias("meta_score"), (F.col("quality") >= threshold).alias("kept"))
