"""Secret scan: three base patterns, and a linear-chain conditional random field beside them.

The field tags tokens as secret begin, inside or outside from the token's shape, the shapes and
key words of its neighbours and features of the whole text, and is decoded by Viterbi. Its weights
are trained here on a bounded sample of texts whose base matches serve as labels (``train``). So that it
goes beyond those patterns, every text with matches is also learnt from in altered copies: key words give way
to other words, values are cut below the patterns' least lengths, lose their opening letters or are spelt
anew in another alphabet, while their tags stay.

Begin and inside share their token weights and differ in the transitions (inside never follows
outside). A token whose outside score leads by more than any change of the transitions around it can
cost is outside on every best path, so Viterbi runs only between such tokens: the same tags as over
the whole text, at the cost of the few tokens that could be secrets.

Work is done on UTF-8 bytes with byte tables; spans are code points, end exclusive. Field spans that
touch a base span are dropped (the base span stays), the rest get the kind ``crf``.

Defined cases: null, empty and secret-free texts have no spans; very long texts are scanned whole;
repeated rows give the same spans; extra columns pass through, clashing names are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_schema, map_pieces, prepared, trimmed, utf8, with_columns, written

# base patterns and least lengths (fixed values)
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "crf")
KEY_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

TRAIN_TEXTS = 1200               # texts the field is trained on (documented bound), half with base matches
SEGMENT = 40                     # tokens of a training chain: whole texts are cut into these
TRAIN_SEGMENTS = 6000            # chains the field is fitted on (documented bound), half with secrets
COPIES = 8                       # altered copies of a training text with matches
LEAST_VALUE = 9                  # characters an altered value has at least
MOST_VALUE = 40
ALPHABETS = (b"0123456789abcdef", b"0123456789abcdefghijklmnopqrstuvwxyz", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_-abcdefghijklmnopqrstuvwxyz")
OTHER_KEYS = (b"credential", b"auth", b"access", b"login", b"private", b"value", b"code", b"pin", b"id", b"user")
UNSEEN = -4.0                    # weight of a token shape before any training
BEGIN, INSIDE, OUTSIDE = range(3)


def _byte_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_DIGIT, _UP, _LOW = _byte_table(b"0123456789"), np.zeros(256, bool), np.zeros(256, bool)
_UP[65:91] = True
_LOW[97:123] = True
_HEXA = _byte_table(b"0123456789abcdef")
_BODY = _DIGIT | _UP | _LOW | _byte_table(b"+/_-")
_BODY[128:] = True               # letters of other scripts
_BLANK = _byte_table(b" \t\n\r\x0b\x0c")
# class of a byte: 0 blank, 1 token body, 2 punctuation
_CLASS = np.where(_BLANK, 0, np.where(_BODY, 1, 2)).astype(np.uint8)


def base_matches(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes, kinds as listed in KINDS."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(raw) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(raw) if m.end() - m.start() >= HEX_LEAST]
    return out


def may_match(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Texts that could hold a base match: a cheap test without misses over all bytes at once."""
    n = len(off) - 1
    flag = np.zeros(n, bool)
    low = LOWER[raw].tobytes()
    for word in KEY_WORDS + (b"akia",):
        at = low.find(word)
        while at >= 0:
            i = int(np.searchsorted(off, at, "right")) - 1
            flag[i] = True
            at = low.find(word, int(off[i + 1]))
    # a run of 16 hexadecimal bytes covers a whole aligned block of 8
    whole = len(raw) // 8 * 8
    if whole:
        full = np.flatnonzero(_HEXA[raw[:whole]].view(np.uint64) == 0x0101010101010101) * 8
        flag[np.searchsorted(off, full, "right") - 1] = True
    return flag


@dataclass(frozen=True)
class Field:
    """Secret-against-outside weight by feature group and value; transitions (3, 3)."""
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    cue: np.ndarray
    text: np.ndarray
    step: np.ndarray


N_SHAPES, N_CUES, N_TEXTS = 7 * 12, 6, 6


def tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of all tokens: runs of body bytes, runs of punctuation."""
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    kind = _CLASS[raw]
    cut = np.empty(len(raw), bool)
    cut[0] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    inner = off[(off > 0) & (off < len(raw))]
    cut[inner] = True
    at = np.flatnonzero(cut)
    end = np.append(at[1:], len(raw))
    solid = kind[at] != 0
    at, end = at[solid], end[solid]
    return at, end, np.searchsorted(off, at, "right") - 1


def text_kind(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature of every whole text: share of digits, by length."""
    total = np.diff(off)
    du = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(_DIGIT[raw], out=du[1:])
    share = (du[off[1:]] - du[off[:-1]]) / np.maximum(total, 1)
    return np.digitize(share, (0.01, 0.1)) * 2 + (total > 2000)


def observe(raw: np.ndarray, off: np.ndarray, at: np.ndarray, end: np.ndarray, doc: np.ndarray):
    """Feature values of every token: shape, cue before it, feature of its text."""
    size = end - at
    body = _CLASS[raw[at]] == 1
    counts = []
    for t in (_DIGIT, _UP, _LOW):
        upto = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(t[raw], out=upto[1:])
        counts.append(upto[end] - upto[at])
    digit, up, low = counts
    length = np.digitize(size, (4, 8, 12, 16, 20, 32))
    # composition: how the body mixes digits with letters of either case
    has_d, has_u, has_l = digit > 0, up > 0, low > 0
    many = digit * 4 >= size
    # every token with letters of other scripts counts as a plain word
    pure = digit + up + low + 2 >= size
    mix = np.select(
        [~body, ~pure, ~has_d & ~has_u, ~has_d & (up == 1), ~has_d & ~has_l, ~has_d,
         ~has_u & ~has_l, has_u & has_l & many, has_u & has_l, has_u & many, has_l & many],
        [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10], 11)
    shape = (length * 12 + mix).astype(np.int16)
    # cue: punctuation and key word just before
    n = len(at)
    cue = np.zeros(n, np.int8)
    if n:
        is_sep = np.zeros(n, bool)
        first = raw[at]
        last = raw[end - 1]
        for c in b":=":
            is_sep |= (first == c) | (last == c)
        is_sep &= ~body
        is_quote = ~body & ((first == ord('"')) | (first == ord("'")))
        key = np.zeros(n, bool)
        maybe = np.flatnonzero(body & (size >= 5) & (size <= 24) & (digit == 0))
        if is_sep.any():
            near = maybe[is_sep[np.minimum(maybe + 1, n - 1)] | is_sep[np.minimum(maybe + 2, n - 1)]]
            for i in near.tolist():
                w = raw[at[i]:end[i]].tobytes().lower().replace(b"_", b"").replace(b"-", b"")
                key[i] = any(w.endswith(k) for k in (b"password", b"passwd", b"secret", b"token", b"key"))
        same1 = np.zeros(n, bool)
        same1[1:] = doc[1:] == doc[:-1]
        same2 = np.zeros(n, bool)
        same2[2:] = doc[2:] == doc[:-2]
        p1 = lambda x: np.concatenate([[False], x[:-1]]) & same1
        p2 = lambda x: np.concatenate([[False, False], x[:-2]])[:n] & same2
        cue = np.select([p1(is_sep) & p2(key), p1(is_sep | is_quote) & p2(is_sep | is_quote | key), p1(key), p1(is_sep), p1(is_quote)],
                        [1, 2, 3, 4, 5], 0).astype(np.int8)
    return shape, cue, text_kind(raw, off)[doc].astype(np.int8)


def neighbours(shape: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shape of the token before and after, N_SHAPES at a text's ends."""
    before = np.full(len(shape), N_SHAPES, np.int16)
    after = before.copy()
    if len(shape) > 1:
        same = doc[1:] == doc[:-1]
        before[1:][same] = shape[:-1][same]
        after[:-1][same] = shape[1:][same]
    return before, after


def emissions(f: Field, shape, before, after, cue, text) -> np.ndarray:
    """Score of being part of a secret; outside scores 0."""
    return f.own[shape] + f.before[before] + f.after[after] + f.cue[cue] + f.text[text]


def margin(step: np.ndarray) -> float:
    """The most that making one begin/inside token outside can cost in transitions: an inside token
    that follows becomes a begin. None stands for a text's end."""
    t = lambda a, b: 0.0 if a is None or b is None else float(step[a, b])
    worst = 0.0
    for p in (None, BEGIN, INSIDE, OUTSIDE):
        for y in (BEGIN, INSIDE):
            if y == INSIDE and p in (None, OUTSIDE):
                continue
            for n in (None, BEGIN, OUTSIDE):
                worst = max(worst, t(p, y) + t(y, n) - t(p, OUTSIDE) - t(OUTSIDE, n))
            for n2 in (None, BEGIN, INSIDE, OUTSIDE):
                worst = max(worst, t(p, y) + t(y, INSIDE) + t(INSIDE, n2)
                            - t(p, OUTSIDE) - t(OUTSIDE, BEGIN) - t(BEGIN, n2))
    return worst


def viterbi(e: np.ndarray, starts: np.ndarray, stops: np.ndarray, left: np.ndarray, right: np.ndarray,
            step: np.ndarray, tags: np.ndarray) -> None:
    """Best tags of the chains ``e[start:stop]``, all chains in step, longest first. ``left`` and
    ``right`` tell whether an outside token stands before and after a chain."""
    order = np.argsort(starts - stops, kind="stable")
    starts, stops, left, right = starts[order], stops[order], left[order], right[order]
    size = stops - starts
    score = lambda i: np.stack([e[i], e[i], np.zeros(len(i))], 1)
    best = score(starts) + np.where(left[:, None], step[OUTSIDE][None], np.array([0.0, -1e9, 0.0]))
    backs = []
    for t in range(1, int(size[0])):
        k = int(np.searchsorted(-size, -t, "left"))          # chains longer than t
        z = best[:k, :, None] + step
        back = z.argmax(1).astype(np.int8)
        backs.append(back)
        best[:k] = np.take_along_axis(z, back[:, None].astype(np.int64), 1)[:, 0] + score(starts[:k] + t)
    last = (best + np.where(right[:, None], step[:, OUTSIDE][None], 0.0)).argmax(1)
    now = last.copy()
    for t in range(int(size[0]) - 1, -1, -1):
        k = int(np.searchsorted(-size, -t, "left"))
        tags[starts[:k] + t] = now[:k]
        if t:
            now[:k] = backs[t - 1][np.arange(k), now[:k]]


def decode(f: Field, e: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Tags of all tokens of many texts."""
    n = len(e)
    tags = np.full(n, OUTSIDE, np.int8)
    open_ = np.flatnonzero(e >= -margin(f.step))
    if len(open_):
        new = np.ones(len(open_), bool)
        new[1:] = (np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])
        starts = open_[new]
        stops = open_[np.append(np.flatnonzero(new)[1:] - 1, len(open_) - 1)] + 1
        left = (starts > 0) & (doc[np.maximum(starts - 1, 0)] == doc[starts])
        right = (stops < n) & (doc[np.minimum(stops, n - 1)] == doc[stops - 1])
        viterbi(e, starts, stops, left, right, f.step, tags)
    return tags


def field_spans(f: Field, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
    """(text number, start, end) in bytes of the tagged stretches."""
    at, end, doc = tokens(raw, off)
    if len(at) == 0:
        return []
    shape, cue, text = observe(raw, off, at, end, doc)
    before, after = neighbours(shape, doc)
    tags = decode(f, emissions(f, shape, before, after, cue, text), doc)
    out: list[list[int]] = []
    previous = -2
    for i in np.flatnonzero(tags != OUTSIDE).tolist():
        if tags[i] == INSIDE and previous == i - 1 and out and out[-1][0] == doc[i]:
            out[-1][2] = int(end[i])
        else:
            out.append([int(doc[i]), int(at[i]), int(end[i])])
        previous = i
    return [tuple(x) for x in out]


def find(f: Field | None, raw: np.ndarray, off: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per text: (start, end, kind) in code points by start, then kind."""
    n = len(off) - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    for i in np.flatnonzero(may_match(raw, off)).tolist():
        found[i] = base_matches(raw[off[i]:off[i + 1]].tobytes())
    if f is not None:
        for i, a, b in field_spans(f, raw, off):
            a, b = a - int(off[i]), b - int(off[i])
            if not any(x < b and a < y for x, y, _ in found[i]):
                found[i].append((a, b, 3))
    for i, spans in enumerate(found):
        if spans:
            part = raw[off[i]:off[i + 1]]
            if (part >= 128).any():                       # bytes to code points
                upto = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                spans = [(int(upto[a]), int(upto[b]), k) for a, b, k in spans]
            found[i] = sorted(spans, key=lambda s: (s[0], s[2], s[1]))
    return found


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(df: DataFrame, f: Field | None, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """Adds the spans of every whole text: array of (kind, start, end), by start, then kind."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = utf8(piece.column(text_col))
        spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in s] for s in find(f, raw, off)]
        return with_columns(piece, {out_col: pa.array(spans, _ARROW_SPANS)})

    return prepared(df).mapInArrow(map_pieces(run, text_col), add_schema(df, **{out_col: SPANS}))


def redact(df: DataFrame, f: Field | None, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every found span of ``text_col`` replaced by ``mark``; null stays null."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = utf8(piece.column(text_col))
        texts = piece.column(text_col).to_pylist()
        for i, spans in enumerate(find(f, raw, off)):
            if spans:
                out, upto = [], 0
                for a, b, _ in spans:
                    if a >= upto:
                        out += [texts[i][upto:a], mark]
                    upto = max(upto, b)
                texts[i] = "".join(out) + texts[i][upto:]
        new = pa.array(texts, pa.string())
        cols = [new if n == text_col else piece.column(n) for n in piece.schema.names]
        return pa.RecordBatch.from_arrays(cols, names=piece.schema.names)

    return prepared(df).mapInArrow(map_pieces(run, text_col), df.schema)


def value_spans(raw: bytes) -> list[tuple[int, int]]:
    """The secrets proper of the base matches: of an assignment only its value."""
    return sorted({(ASSIGN.match(raw, a).start(2) if k == 0 else a, b) for a, b, k in base_matches(raw)})


def altered(raw: bytes, rng: np.random.Generator) -> tuple[bytes, list[tuple[int, int]]]:
    """A copy of a text in which its secrets look less like the base patterns, and where they are then."""
    out, spans, upto, size = [], [], 0, 0
    words = [w for w in re.findall(rb"[a-z]{3,9}", raw[:4000])] or [b"and"]
    for a, b in value_spans(raw):
        if a < upto:
            continue
        head, value = raw[upto:a], raw[a:b]
        key = re.search(rb"(?i)(password|passwd|secret|token|api_?key)(?=[^A-Za-z0-9]*$)", head)
        way = rng.integers(4)
        if key and way < 3:                                      # another key, any word, or none
            new = OTHER_KEYS[rng.integers(len(OTHER_KEYS))] if way == 0 else words[rng.integers(len(words))]
            head = head[:key.start()] + (new + head[key.end():] if way < 2 else b"")
        if value.startswith(b"AKIA") and rng.random() < 0.5:
            value = value[4:]
        length = int(rng.integers(LEAST_VALUE, 17 if rng.random() < 0.5 else MOST_VALUE + 1))
        if rng.random() < 0.7:                                   # spelt anew, digits and letters both
            letters = ALPHABETS[rng.integers(len(ALPHABETS))]
            value = rng.choice(list(letters), length - 2).astype(np.uint8).tobytes() + b"7" + letters[-1:]
        elif len(value) > LEAST_VALUE and not value[:length].isdigit():
            value = value[:length]
        out += [head, value]
        size += len(head)
        spans.append((size, size + len(value)))
        size += len(value)
        upto = b
    return b"".join([*out, raw[upto:]]), spans


def _training_chain(raw: bytes, kind: int | None = None, spans: list[tuple[int, int]] | None = None) -> tuple[np.ndarray, ...] | None:
    """Features and tags of one training text (of this ``kind``, if given) with its secrets at ``spans``, by
    default those of the base patterns."""
    part = np.frombuffer(raw, np.uint8)
    off = np.array([0, len(part)])
    at, end, doc = tokens(part, off)
    if len(at) == 0:
        return None
    shape, cue, text = observe(part, off, at, end, doc)
    if kind is not None:
        text = np.full_like(text, kind)
    before, after = neighbours(shape, doc)
    tags = np.full(len(at), OUTSIDE, np.int8)
    for a, b in value_spans(raw) if spans is None else spans:
        inside = np.flatnonzero((at < b) & (end > a))
        tags[inside] = INSIDE
        tags[inside[:1]] = BEGIN
    return shape, before, after, cue, text, tags


def segments(chain: tuple[np.ndarray, ...] | None) -> list[tuple[np.ndarray, ...]]:
    """A whole text's chain in pieces of about SEGMENT tokens that part no secret."""
    if chain is None:
        return []
    tags, cuts = chain[5], [0]
    while cuts[-1] < len(tags):
        at = min(cuts[-1] + SEGMENT, len(tags))
        while at < len(tags) and tags[at] == INSIDE:
            at += 1
        cuts.append(at)
    return [tuple(c[a:b] for c in chain) for a, b in zip(cuts[:-1], cuts[1:])]


def fit(chains: list[tuple[np.ndarray, ...]], rounds: int = 40, rate: float = 0.3, l2: float = 1e-4) -> Field | None:
    """Maximum likelihood by gradient ascent (Adam); forward-backward over all chains in step."""
    chains = sorted((c for c in chains if c is not None and len(c[0])), key=lambda c: -len(c[0]))
    if not chains or not any((c[5] != OUTSIDE).any() for c in chains):
        return None
    width = len(chains[0][0])
    n = len(chains)
    pad = lambda k, fill: np.stack([np.concatenate([c[k], np.full(width - len(c[k]), fill, c[k].dtype)]) for c in chains])
    feats = [pad(k, 0).astype(np.int64) for k in range(5)]
    tags = pad(5, OUTSIDE).astype(np.int64)
    mask = np.arange(width)[None, :] < np.array([len(c[0]) for c in chains])[:, None]
    sizes = (N_SHAPES, N_SHAPES + 1, N_SHAPES + 1, N_CUES, N_TEXTS)
    prior = [np.full(N_SHAPES, UNSEEN), *(np.zeros(s) for s in sizes[1:]), np.zeros((3, 3))]   # a shape never seen is no secret
    w = [p.copy() for p in prior]
    legal = np.ones((3, 3))
    legal[OUTSIDE, INSIDE] = 0
    inside = (tags != OUTSIDE) & mask
    seen = [np.bincount(fv.ravel(), inside.ravel(), s) for fv, s in zip(feats, sizes)]
    pair = np.zeros((3, 3))
    both = mask[:, 1:]
    np.add.at(pair, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    seen.append(pair)
    m1, m2 = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    live, total = mask.sum(0), mask.sum()
    for r in range(1, rounds + 1):
        secret = sum(wk[fv] for wk, fv in zip(w[:5], feats))
        e = np.stack([secret, secret, np.zeros_like(secret)], 2)
        step = np.where(legal > 0, w[5], -1e9)
        alpha = np.empty((n, width, 3))
        alpha[:, 0] = e[:, 0] + np.array([0, -1e9, 0])
        for t in range(1, width):
            k = live[t]                                 # chains are sorted by length
            z = alpha[:k, t - 1, :, None] + step
            top = z.max(1)
            alpha[:k, t] = np.log(np.exp(z - top[:, None]).sum(1)) + top + e[:k, t]
            alpha[k:, t] = alpha[k:, t - 1]
        logz = np.logaddexp.reduce(alpha[:, -1], axis=1)
        beta = np.zeros((n, width, 3))
        pair_hat = np.zeros((3, 3))
        for t in range(width - 2, -1, -1):
            k = live[t + 1]
            z = step[None] + (e[:k, t + 1] + beta[:k, t + 1])[:, None, :]
            top = z.max(2)
            beta[:k, t] = np.log(np.exp(z - top[..., None]).sum(2)) + top
            pair_hat += np.exp(alpha[:k, t, :, None] + z - logz[:k, None, None]).sum(0)
        post = np.exp(alpha + beta - logz[:, None, None])[..., :OUTSIDE].sum(2) * mask
        hat = [np.bincount(fv.ravel(), post.ravel(), s) for fv, s in zip(feats, sizes)] + [pair_hat]
        for i in range(6):
            g = (seen[i] - hat[i]) / total * 100 - l2 * (w[i] - prior[i])
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            w[i] = w[i] + rate * (m1[i] / (1 - 0.9 ** r)) / (np.sqrt(m2[i] / (1 - 0.999 ** r)) + 1e-8)
    w[5] = np.where(legal > 0, w[5], -1e9)
    return Field(*w)


def train(docs: DataFrame, text_col: str = "text", max_texts: int = TRAIN_TEXTS, max_segments: int = TRAIN_SEGMENTS) -> Field | None:
    """Train on a bounded sample: of all distinct texts, the ``max_texts / 2`` with the smallest hash
    among those with a base match and as many among those without. Tasks turn these whole texts into chains;
    at most ``max_segments`` of them, by hash, come to the driver, half of them with secrets. None when no text
    has a match: then only the base patterns are scanned for."""
    text = F.col(text_col)
    known = docs.where(text.isNotNull()).select(F.xxhash64(text).alias("h"), text.alias("text"))

    def flagged(p: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = utf8(p.column("text"))
        hit = may_match(raw, off)
        for i in np.flatnonzero(hit).tolist():
            hit[i] = bool(base_matches(raw[off[i]:off[i + 1]].tobytes()))
        return pa.RecordBatch.from_arrays([p.column("h"), pa.array(hit)], names=["h", "hit"])

    seen = prepared(known).mapInArrow(map_pieces(flagged, "text"), "h long, hit boolean")
    seen = written(seen.groupBy("h").agg(F.max("hit").alias("hit")), "secrets-hashes")
    half = max_texts // 2
    least = seen.where("hit").orderBy("h").limit(half).unionByName(seen.where("not hit").orderBy("h").limit(half))

    def chains(batches):
        for batch in batches:
            for h, t in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                raw, rng = t.encode(), np.random.default_rng(h & (1 << 63) - 1)
                found = segments(_training_chain(raw))
                if value_spans(raw):
                    for _ in range(COPIES):
                        copy, spans = altered(raw, rng)
                        more = segments(_training_chain(copy, None, spans))
                        found += [s for s in more if (s[5] != OUTSIDE).any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()),
                     pa.array([bool((s[5] != OUTSIDE).any()) for s in found], pa.bool_()),
                     pa.array([np.stack([c.astype("<i2") for c in s]).tobytes() for s in found], pa.binary())], names=["h", "n", "secret", "chain"])

    # at most max_texts hashes are broadcast
    rows = (prepared(known).join(F.broadcast(least.select("h")), "h").mapInArrow(trimmed(chains), "h long, n int, secret boolean, chain binary")
            .dropDuplicates(["h", "n"]))
    rows = written(rows.withColumn("r", F.xxhash64("h", "n")), "secrets-chains")
    got = []
    for secret in ("secret", "not secret"):
        for r in rows.where(secret).orderBy("r").limit(max_segments // 2).collect():
            got.append(tuple(np.frombuffer(bytes(r.chain), "<i2").reshape(6, -1)))
    return fit(got)


def spans_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined in their order."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets_report(docs: DataFrame) -> DataFrame:
    found = scan(docs.select("doc_id", "text"), train(docs)).drop("text")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(spans_text(F.col("spans"), KINDS[:3]), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))
