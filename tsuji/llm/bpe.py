"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

Pre-tokenisation uses no regular expression. Code points become symbols (letter, number, other,
white space with what follows it, apostrophe that opens a contraction). The pattern's left-to-right
choice is a small automaton over those symbols; since composing transition functions is
associative, the states of all positions come from a blocked prefix scan over the automaton's
function monoid: every block is composed independently, block results are chained, and the states
inside blocks follow. A function of the monoid is one small integer, a composition one table look-up.

Slices between boundaries are looked up in a cache of finished merges; a miss runs the pair merges
(lowest rank first, leftmost on ties) with a heap, so one very long word costs n log n.

Defined cases: null text = empty text = no ids; special-token strings are ordinary text; repeated
rows and ids are independent; extra columns pass through, a column named like an output is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_schema, map_pieces, prepared, utf8, with_columns

# white space as Unicode defines it (fixed values)
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# contractions after an apostrophe (fixed values of the pattern)
SUFFIX_1 = "stmd"
SUFFIX_2 = ("re", "ve", "ll")

CACHE_BYTES = 40_000_000        # finished merges kept per Python worker; emptied when full
CACHE_WORD_CHARS = 64           # longer slices are not cached

# symbols
LETTER, NUMBER, OTHER, SPACE_RUN, SPACE_LAST, BLANK_LAST, QUOTE_1, QUOTE_2 = range(8)
FIRST = 8                       # added to the first symbol of a text: forget what came before
# states after a symbol
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, PREFIX, NEED_1, NEED_2 = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, does a slice start here)."""
    if symbol == LETTER:
        if state == NEED_2:
            return NEED_1, False
        if state == NEED_1:
            return CLOSED, False
        return IN_LETTERS, state not in (IN_LETTERS, PREFIX)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, PREFIX)
    if symbol == OTHER:
        return IN_OTHER, state not in (IN_OTHER, PREFIX)
    if symbol in (QUOTE_1, QUOTE_2):
        if state in (IN_OTHER, PREFIX):
            return IN_OTHER, False
        return (NEED_1 if symbol == QUOTE_1 else NEED_2), True
    if symbol == SPACE_RUN:
        return IN_SPACE, state != IN_SPACE
    return (PREFIX if symbol == SPACE_LAST else CLOSED), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each symbol, composition table, result of each function from CLOSED,
    start flag by state and symbol). The monoid is closed by repeated composition."""
    plain = [tuple(_step(s, y)[0] for s in range(8)) for y in range(8)]
    gens = plain + [(p[CLOSED],) * 8 for p in plain]
    ident = tuple(range(8))
    ids = {ident: 0}
    todo = [ident]
    while todo:
        f = todo.pop()
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in ids:
                ids[h] = len(ids)
                todo.append(h)
    funcs = list(ids)
    table = np.array([[ids[tuple(g[x] for x in f)] if tuple(g[x] for x in f) in ids else 0 for g in funcs]
                      for f in funcs], np.int32)
    start = np.zeros((8, 16), bool)
    for s in range(8):
        for y in range(8):
            start[s, y] = _step(s, y)[1]
            start[s, y + FIRST] = True
    return (np.array([ids[g] for g in gens], np.int32), table,
            np.array([f[CLOSED] for f in funcs], np.uint8), start)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point: LETTER, NUMBER, OTHER or SPACE_RUN."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            out[c] = LETTER
        elif k == "N":
            out[c] = NUMBER
    out[list(WHITE_SPACE)] = SPACE_RUN
    return out


def symbols(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of every code point of texts laid back to back; ``first`` marks text beginnings."""
    n = len(cps)
    kind = classes()[cps]
    sym = kind.copy()
    ends = np.ones(n, bool)                     # last of its text
    ends[:-1] = first[1:]
    nxt_space = np.ones(n, bool)
    nxt_space[:-1] = kind[1:] == SPACE_RUN
    last = (kind == SPACE_RUN) & ~nxt_space & ~ends
    sym[last] = BLANK_LAST
    sym[last & (cps == 0x20)] = SPACE_LAST
    q = np.flatnonzero(cps == 0x27)
    if len(q):
        text_of = np.cumsum(first, dtype=np.int32)
        padded = np.concatenate([cps, np.zeros(2, cps.dtype)])
        owner = np.concatenate([text_of, np.full(2, -1, np.int32)])
        one = (owner[q + 1] == text_of[q]) & np.isin(padded[q + 1], [ord(c) for c in SUFFIX_1])
        two = np.zeros(len(q), bool)
        for a, b in SUFFIX_2:
            two |= (padded[q + 1] == ord(a)) & (padded[q + 2] == ord(b))
        two &= owner[q + 2] == text_of[q]
        sym[q[two]] = QUOTE_2
        sym[q[one]] = QUOTE_1
    sym[first] += FIRST
    return sym


def boundaries(sym: np.ndarray, block: int = 128) -> np.ndarray:
    """True where a slice starts: blocked prefix scan over transition functions."""
    n = len(sym)
    if n == 0:
        return np.zeros(0, bool)
    gen, comp, from_closed, start = automaton()
    m = len(comp)
    flat = comp.ravel()
    width = -(-n // block)
    padded = np.full(width * block, LETTER, np.uint8)
    padded[:n] = sym
    grid = gen[padded].reshape(width, block).T.copy()      # column = block, row = place in the block
    prefix = np.empty_like(grid)
    prefix[0] = grid[0]
    for i in range(1, block):                              # compose inside all blocks at once
        np.take(flat, prefix[i - 1] * m + grid[i], out=prefix[i])
    entry = prefix[-1].copy()                              # chain the blocks' functions (doubling)
    shift = 1
    while shift < width:
        joined = entry.copy()
        joined[shift:] = flat[entry[:-shift] * m + entry[shift:]]
        entry, shift = joined, shift * 2
    before = np.zeros(width, np.int32)
    before[1:] = entry[:-1]
    state = from_closed[flat[before[None, :] * m + prefix]].T.ravel()[:n]   # after each position
    previous = np.empty(n, np.uint8)
    previous[0] = CLOSED
    previous[1:] = state[:-1]
    return start.ravel()[previous.astype(np.int32) * 16 + sym]


class Vocabulary:
    """Ranks of byte strings, with the layouts encoding and decoding need."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for w, r in self.ranks.items():
            words[r] = w
        self.length = np.array([len(w) for w in words], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.blob = np.frombuffer(b"".join(words), np.uint8)
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def merge(self, piece: bytes) -> list[int]:
        """Pair merges of one slice: lowest rank first, leftmost first among equals."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))                 # part that begins at i ends at end[i]
        prev = list(range(-1, n - 1))
        alive = [True] * n
        heap = []
        for i in range(n - 1):
            r = ranks.get(piece[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        while heap:
            r, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue                            # one of the two parts has changed since
            end[i], alive[j] = stop, False
            if stop < n:
                prev[stop] = i
                k = ranks.get(piece[i:end[stop]])
                if k is not None:
                    heapq.heappush(heap, (k, i, end[stop]))
            p = prev[i]
            if p >= 0:
                k = ranks.get(piece[p:stop])
                if k is not None:
                    heapq.heappush(heap, (k, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode_slice(self, piece: str) -> bytes:
        ids = np.array(self.merge(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= CACHE_WORD_CHARS:
            if self.cached > CACHE_BYTES:
                self.cache.clear()
                self.cached = 0
            self.cache[piece] = ids
            self.cached += 200 + 4 * len(piece) + len(ids)      # about what the entry takes
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian uint32 ids of each text."""
        joined = "".join(texts)
        cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        first = np.zeros(len(cps), bool)
        first[(ends - lengths)[lengths > 0]] = True
        begins = np.flatnonzero(boundaries(symbols(cps, first)))
        upto = np.searchsorted(begins, ends).tolist()
        begins = begins.tolist()
        begins.append(len(joined))
        get, miss, out, a = self.cache.get, self.encode_slice, [], 0
        for b in upto:
            slices = [joined[x:y] for x, y in zip(begins[a:b], begins[a + 1:b + 1])]
            out.append(b"".join([get(s) or miss(s) for s in slices]))
            a = b
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset at which each token begins."""
        size = self.length[ids]
        return np.cumsum(size) - size

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """Token bytes copied to their retained offsets, all at once."""
        if len(ids) == 0:
            return b""
        size = self.length[ids]
        total = int(offsets[-1] + size[-1])
        at = np.repeat(self.begin[ids] - offsets, size)
        at += np.arange(total)
        return self.blob[at].tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(df: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "token_ids",
           offsets_col: str = "token_offsets") -> DataFrame:
    """Adds ``ids_col`` (binary: packed little-endian uint32 ids) and ``offsets_col`` (binary: packed
    little-endian uint32 byte offset of each token in the text's UTF-8)."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(vocab_path)
        ids = v.encode([t or "" for t in piece.column(text_col).to_pylist()])
        offs = [v.offsets(np.frombuffer(b, "<u4")).astype("<u4").tobytes() for b in ids]
        return with_columns(piece, {ids_col: pa.array(ids, pa.binary()), offsets_col: pa.array(offs, pa.binary())})

    schema = add_schema(df, **{ids_col: T.BinaryType(), offsets_col: T.BinaryType()})
    return prepared(df).mapInArrow(map_pieces(run, text_col), schema)


def decode(df: DataFrame, vocab_path: str, ids_col: str = "token_ids", offsets_col: str = "token_offsets",
           out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col`` (binary): the bytes the ids stand for; null ids decode to no bytes."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(vocab_path)
        out = [v.decode(np.frombuffer(a or b"", "<u4").astype(np.int64), np.frombuffer(o or b"", "<u4").astype(np.int64))
               for a, o in zip(piece.column(ids_col).to_pylist(), piece.column(offsets_col).to_pylist())]
        return with_columns(piece, {out_col: pa.array(out, pa.binary())})

    return prepared(df).mapInArrow(map_pieces(run, ids_col), add_schema(df, **{out_col: T.BinaryType()}))


def round_trip_report(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document. Texts are encoded and decoded in
    one Python pass: only counts and digests leave it."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(vocab_path)
        counts, coded, decoded = [], [], []
        for ids in v.encode([t or "" for t in piece.column("text").to_pylist()]):
            numbers = np.frombuffer(ids, "<u4").astype(np.int64)
            counts.append(len(numbers))
            coded.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(v.decode(numbers, v.offsets(numbers))).hexdigest())
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                                           pa.array(decoded, pa.string())], names=schema.names)

    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return prepared(rows).mapInArrow(map_pieces(run, "text"), schema)
