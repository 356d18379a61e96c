"""Periodic runs of words, found with a run-length grammar built by recompression.

A run is a stretch of words with a smallest period q that holds the period at least four times (and at
least six words) and cannot be extended. Three steps, each on all texts of a piece at once:

* Harmonic grid. Two words q apart agree along all of a run but its last q words, so for each q every
  run is met on a grid whose step grows with q (n log n places in all). A place counts when three words
  in a row agree with those q later.
* Grammar. The word sequence is rewritten in rounds: first every maximal block of one symbol becomes a
  symbol (symbol, length), then the symbols are split in two classes and every pair of a first-class and
  a second-class symbol becomes a symbol. Rules depend on the symbols alone, so equal stretches are
  rewritten alike but for their ends. The rounds go on until every text is one symbol.
* Extension. How far two places agree, forwards or backwards, is read off the grammar: equal symbols
  are passed whole while going up the rounds, and after the first difference one symbol a round is looked
  at on the way down. That takes O(rounds) steps without suffix arrays; all queries of a piece take each
  step together.

A stretch found with a multiple of its smallest period is the same stretch, so the smallest period found for
(start, length) is its period.

Defined cases: a null or empty text has no words and no runs; a null doc_id is never rewritten by the rule
below; repeated rows are independent; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_pieces, mix64, prepared

LEAST_TIMES = 4                  # a run holds its period so often
LEAST_WORDS = 6
IN_A_ROW = 3                     # words that must agree at a grid place


def least_length(q):
    """Least number of words of a run with period q."""
    return np.maximum(LEAST_WORDS, LEAST_TIMES * q)


@dataclass
class Round:
    """One sequence of the grammar. ``parent`` leads to the symbol of the next sequence that covers a
    symbol, ``block`` tells whether that step joined blocks; ``first`` is each symbol's first symbol in the
    sequence before."""

    symbol: np.ndarray
    first: np.ndarray
    parent: np.ndarray | None = None
    block: bool = False


class Grammar:
    """Run-length grammar of word sequences laid back to back. ``fence`` marks the places between
    them: a fence is a symbol of its own that no rule takes in."""

    def __init__(self, words: np.ndarray, fence: np.ndarray):
        symbol = words.astype(np.int32)
        self.free = int(symbol.max(initial=-1)) + 1
        fences = int(fence.sum())
        symbol[fence] = self.free + np.arange(fences, dtype=np.int32)
        self.free += fences
        fenced = fence.copy()
        self.rounds = [Round(symbol, np.arange(len(symbol), dtype=np.int32))]
        number = 0
        while len(symbol) > 2 * fences - 1:                      # until every text is one symbol
            for block in (True, False):
                heads = self._blocks(symbol) if block else self._pairs(symbol, fenced, number)
                first = np.flatnonzero(heads).astype(np.int32)
                if len(first) == len(symbol):
                    continue                                     # nothing to join
                last = self.rounds[-1]
                last.parent, last.block = np.cumsum(heads, dtype=np.int32) - 1, block
                size = np.diff(np.append(first, len(symbol)))
                symbol = self._named(symbol, first, size, block)
                fenced = fenced[first]
                self.rounds.append(Round(symbol, first))
            number += 1

    @staticmethod
    def _blocks(symbol: np.ndarray) -> np.ndarray:
        """First symbol of every maximal block; fences are unique, so each is a block alone."""
        heads = np.ones(len(symbol), bool)
        heads[1:] = symbol[1:] != symbol[:-1]
        return heads

    @staticmethod
    def _pairs(symbol: np.ndarray, fenced: np.ndarray, number: int) -> np.ndarray:
        """True but at the second symbols of pairs; a symbol's class is a bit of its hash in this round."""
        salt = np.uint64((number * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
        second = (mix64(symbol.astype(np.uint64) ^ salt) & np.uint64(1)).astype(bool)
        heads = np.ones(len(symbol), bool)
        heads[1:] = ~(~second[:-1] & second[1:] & ~fenced[:-1] & ~fenced[1:])
        return heads

    def _named(self, symbol: np.ndarray, first: np.ndarray, size: np.ndarray, block: bool) -> np.ndarray:
        """Symbols after a step: joined ones get one new name per (symbol, length) or pair."""
        out = symbol[first]
        joined = np.flatnonzero(size > 1)
        if len(joined):
            left = out[joined]
            right = size[joined] if block else symbol[first[joined] + 1]
            order = np.lexsort((right, left))
            a, b = left[order], right[order]
            new = np.ones(len(order), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            names = np.empty(len(order), np.int32)
            names[order] = self.free + np.cumsum(new) - 1
            out[joined] = names
            self.free += int(new.sum())
        return out

    def _left(self, r: int, p: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols of round r's block remain at places p, p included."""
        up = self.rounds[r].parent[p]
        first = self.rounds[r + 1].first
        if not forward:
            return p - first[up] + 1
        end = np.append(first, len(self.rounds[r].symbol))[up + 1]
        return end - p

    def common(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Words on which the sequences from i and from j (i < j) agree; backwards: those before i and
        before j. The sequence must begin and end with a fence."""
        step = 1 if forward else -1
        p, q = (i, j) if forward else (i - 1, j - 1)
        p, q = p.copy(), q.copy()
        stopped = np.full(len(p), -1)                            # round where the symbols differ
        live = np.arange(len(p))
        top = len(self.rounds) - 1
        for r in range(top + 1):
            here = self.rounds[r]
            a, b = p[live], q[live]
            same = here.symbol[a] == here.symbol[b]
            stopped[live[~same]] = r
            live, a, b = live[same], a[same], b[same]
            if not len(live) or r == top:
                break
            if here.block:
                x, y = self._left(r, a, forward), self._left(r, b, forward)
                short = np.minimum(x, y)
                differ = x != y                                  # past the shorter rest the symbols differ
                p[live[differ]] = (a + step * short)[differ]
                q[live[differ]] = (b + step * short)[differ]
                stopped[live[differ]] = r
                live, a, b = live[~differ], a[~differ], b[~differ]
                p[live], q[live] = here.parent[a] + step, here.parent[b] + step
            else:
                edge = self._edges(r, a, forward) & self._edges(r, b, forward)
                a, b = a + step * ~edge, b + step * ~edge        # past the second half of a pair
                fit = edge | (here.symbol[a] == here.symbol[b])
                stopped[live[~fit]] = r
                p[live], q[live] = a, b
                live, a, b = live[fit], a[fit], b[fit]
                p[live], q[live] = here.parent[a], here.parent[b]
        for r in range(top, 0, -1):
            down = np.flatnonzero(stopped >= r)
            if not len(down):
                continue
            a, b = self._inside(r, p[down], forward), self._inside(r, q[down], forward)
            below = self.rounds[r - 1]
            same = below.symbol[a] == below.symbol[b]
            if below.block:
                x, y = self._left(r - 1, a, forward), self._left(r - 1, b, forward)
                pace = np.where(same, np.minimum(x, y), 0)
            else:
                pace = same.astype(np.int64)
            p[down], q[down] = a + step * pace, b + step * pace
        return p - i if forward else i - 1 - p

    def _edges(self, r: int, p: np.ndarray, forward: bool) -> np.ndarray:
        """Does the covering symbol begin (backwards: end) at place p?"""
        up = self.rounds[r].parent[p]
        first = self.rounds[r + 1].first
        return first[up] == p if forward else np.append(first, len(self.rounds[r].symbol))[up + 1] == p + 1

    def _inside(self, r: int, p: np.ndarray, forward: bool) -> np.ndarray:
        """First (backwards: last) symbol that place p of round r covers in the sequence before."""
        first = self.rounds[r].first
        return first[p] if forward else np.append(first, len(self.rounds[r - 1].symbol))[p + 1] - 1


def _octave(low: int, begin: np.ndarray, count: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the grid places for periods low .. 2 low - 1 where IN_A_ROW words agree."""
    longest = np.where(count >= LEAST_WORDS, count // LEAST_TIMES, 0)
    periods = np.maximum(np.minimum(longest, 2 * low - 1) - low + 1, 0)
    text = np.repeat(np.arange(len(count)), periods)
    q = low + np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods)
    step = least_length(q) - q - (IN_A_ROW - 1)
    places = np.maximum((count[text] - q - IN_A_ROW) // step + 1, 0)
    owner = np.repeat(np.arange(len(q)), places)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(places) - places, places)
    at, q = begin[text][owner] + nth * step[owner], q[owner]
    for k in range(IN_A_ROW):
        keep = words[at + k] == words[at + q + k]
        at, q = at[keep], q[keep]
    return at, q


def runs(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run of the texts whose word numbers are laid back to
    back in ``words``, ``count`` words each; by text, start, period."""
    begin = np.cumsum(count) - count
    octaves = [1 << k for k in range(int(count.max(initial=0) // LEAST_TIMES).bit_length())] or [1]
    worth = np.zeros(len(count), bool)                           # texts with a grid place
    for low in octaves:
        at, _ = _octave(low, begin, count, words)
        worth[np.searchsorted(begin, at, "right") - 1] = True
    chosen = np.flatnonzero(worth)
    none = np.zeros(0, np.int64)
    if not len(chosen):
        return none, none, none, none

    size = count[chosen]
    total = int(size.sum()) + len(chosen) + 1
    fence = np.zeros(total, bool)
    starts = np.cumsum(size + 1) - size                          # one fence before each text, one at the end
    fence[starts - 1] = True
    fence[-1] = True
    laid = np.zeros(total, np.int64)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    laid[np.repeat(starts, size) + inner] = words[np.repeat(begin[chosen], size) + inner]
    grammar = Grammar(laid, fence)

    known_end = np.zeros(total, np.int64)                        # a run found so far that covers a place
    known_q = np.ones(total, np.int64)
    found = []
    for low in octaves:
        at, q = _octave(low, starts, size, laid)
        new = ~((known_end[at] > at + q) & (q % known_q[at] == 0))   # else: that run again
        at, q = at[new], q[new]
        if not len(at):
            continue
        after = grammar.common(at, at + q, True)
        before = grammar.common(at, at + q, False)
        s, length = at - before, before + after + q
        long = length >= least_length(q)
        hits = np.unique(np.stack([s[long], length[long], q[long]]), axis=1)
        found.append(hits)
        for a, m, w in hits.T.tolist():
            if known_end[a] < a + m:
                known_end[a:a + m], known_q[a:a + m] = a + m, w
    if not found:
        return none, none, none, none
    s, length, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, length, s))
    s, length, q = s[order], length[order], q[order]
    new = np.ones(len(s), bool)                                  # of one stretch the smallest period
    new[1:] = (s[1:] != s[:-1]) | (length[1:] != length[:-1])
    s, length, q = s[new], length[new], q[new]
    order = np.lexsort((q, s))
    s, length, q = s[order], length[order], q[order]
    where = np.searchsorted(starts, s, "right") - 1
    return chosen[where], s - starts[where], length, q


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a planted repetition: one document in ten, chosen by the checksum of its id."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    times = -(-(n - a) // p)
    return words[:a] + (cycle * times)[:n - a]


REPORT = T.StructType([
    T.StructField("n_runs", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()), T.StructField("exponent_milli", T.LongType()),
    T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())])


def _summary(words: list[bytes], start: list[int], length: list[int], period: list[int]) -> tuple:
    best = min(zip(start, length, period), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listing = "".join(f"{s},{m},{q}\n" for s, m, q in zip(start, length, period))
    kept = words
    if best:
        cover = np.zeros(len(words) + 1, np.int64)               # a run repeats itself after its first period
        np.add.at(cover, np.array(start) + np.array(period), 1)
        np.add.at(cover, np.array(start) + np.array(length), -1)
        kept = [w for w, c in zip(words, np.cumsum(cover).tolist()) if not c]
    s, m, q = best or (None, None, None)
    return (len(start), s, m, q, 1000 * m // q if best else None, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def runs_of(texts: list[list[bytes]]) -> list[tuple[list[int], list[int], list[int]]]:
    """(starts, lengths, periods) of the runs of each word sequence, by start, then period."""
    number: dict[bytes, int] = {}
    count = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(count.sum()))
    text, start, length, period = runs(words, count)
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]


def run_report(docs: DataFrame) -> DataFrame:
    """Runs of every document after ``repeated``: their number, the one with the most periods, the digest
    of all and of the words that remain when every run is cut down to its first period."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        ids = piece.column("doc_id")
        texts = [repeated(t.encode().split(), i) if t else []
                 for t, i in zip(piece.column("text").to_pylist(), ids.to_pylist())]
        rows = [_summary(w, *r) for w, r in zip(texts, runs_of(texts))]
        return pa.RecordBatch.from_arrays(
            [ids, *(pa.array([r[k] for r in rows], pa.string() if f.dataType == T.StringType() else pa.int64())
                    for k, f in enumerate(REPORT.fields))], names=["doc_id", *REPORT.names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return prepared(rows).mapInArrow(map_pieces(run, "text"), T.StructType([rows.schema["doc_id"], *REPORT.fields]))
