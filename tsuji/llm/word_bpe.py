"""BPE with word ends: long unsplit text is encoded by halves whose codes are joined exactly.

Text is normalised, split into words by code-point classes, and every word is merged on its own. Short words
are merged directly and cached. A long word is cut into leaves that are merged independently, and the
codes of two neighbours are joined by encoding a window around the seam again: if the window's code begins
with the token it began with before and ends with the one it ended with, it replaces the old tokens; else
the window grows on the side that disagrees, at most to the end of that half. Joins go pairwise up a tree.

Why this is exact: merges form tokens only from tokens formed earlier (checked when a vocabulary is
loaded), so a token sequence is the code of its text if and only if the code of every two neighbours is these
two tokens. All neighbours of the joined sequence are neighbours in the code of a half or of the window.

Very long texts are also spread over tasks: one task normalises and cuts them, the blocks of words and the
leaves of long words are shuffled and encoded wherever there is room, and the task that receives a text's codes
in order only joins seams.

Defined cases: a null text is an empty text, which has no ids; special tokens written in a text are their
ids, as the file says; text with code points that Python's Unicode tables do not know is normalised and split
by the tokenizers library itself; repeated rows are independent; extra columns pass through, and one named
like an output is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import struct
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import NUMBER, SPACE_RUN, SUFFIX_1, SUFFIX_2, classes
from .common import map_pieces, prepared, trimmed, with_columns, written

LEAF = 256                       # symbols of a long word merged at once
WINDOW = 4                       # tokens on each side of a seam to begin with
SPREAD_CHARS = 65_536            # longer texts are cut into blocks for several tasks
BLOCK_CHARS = 16_384             # code points of such a block
FEW = 24                         # tokens up to which merges look through all neighbours
CACHE_BYTES = 64_000_000         # finished words kept per Python worker; emptied when full
CACHE_WORD_CHARS = 64            # longer words are not cached

NO_RULE = 1 << 62

Word = "str | int"               # a word to encode, or the id of a special token


def packed(ids: list[int]) -> bytes:
    """Little-endian uint32."""
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_letters() -> str:
    """The letter that stands for each byte: itself where that is a visible Latin-1 character, else the
    next unused code point from 256 on."""
    spare = iter(range(256, 512))
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return "".join(chr(b if b in seen else next(spare)) for b in range(256))


@lru_cache(maxsize=1)
def unknown() -> np.ndarray:
    """Code points that Python's tables leave unassigned."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def normalised(text: str) -> str:
    """Composed and lower case, each character on its own (so no final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def spans(joined: str) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the words of normalised text: runs of letters, single numbers, runs of other
    characters, and contractions after an apostrophe that begins a word. White space separates."""
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(cps)
    kind = classes()[cps]
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    mark = np.flatnonzero((cps == 0x27) & change)                # an apostrophe inside a run of others is one of them
    if len(mark):
        padded = np.concatenate([cps, np.zeros(3, np.uint32)])
        size = np.isin(padded[mark + 1], [ord(c) for c in SUFFIX_1]).astype(np.int64)
        for a, b in SUFFIX_2:
            size[(padded[mark + 1] == ord(a)) & (padded[mark + 2] == ord(b))] = 2
        mark, size = mark[size > 0], size[size > 0]
        change[mark + 1] = False
        after = mark + 1 + size
        change[after[after < n]] = True
    cut = np.flatnonzero(change)
    ends = np.append(cut[1:], n)
    word = kind[cut] != SPACE_RUN
    return cut[word], ends[word]


class Vocabulary:
    """Merges of a tokenizer file, as tables over token numbers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["byte_fallback"] or model["continuing_subword_prefix"] or spec["decoder"]:
            raise ValueError("expected byte-level BPE with word ends and no decoder")
        self.path = path
        ids = model["vocab"]
        end = model["end_of_word_suffix"]
        self.rule: dict[int, int] = {}                           # left << 32 | right -> rank of the merge
        self.product: list[int] = []                             # token each rank forms
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.final = [ids[c + end] for c in letters]
        formed = {*self.inner, *self.final}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, new = ids[a], ids[b], ids[a + b]
            if new in formed or x not in formed or y not in formed:
                raise ValueError(f"merge {rank} is not made of earlier ones: joining by windows would not be exact")
            formed.add(new)
            self.rule[x << 32 | y] = rank
            self.product.append(new)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens are expected to match literally")
        self.special = added
        self.special_mark = os.path.commonprefix(list(added))    # a quick look whether a text holds any
        self.special_at = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.names = [""] * (max([*ids.values(), *added.values()]) + 1)
        for name, i in (*ids.items(), *added.items()):
            self.names[i] = name
        self.symbols: list[tuple[int, ...]] = [()] * len(self.names)    # one-byte tokens each token is made of
        for i in (*self.inner, *self.final):
            self.symbols[i] = (i,)
        for key, rank in self.rule.items():
            self.symbols[self.product[rank]] = self.symbols[key >> 32] + self.symbols[key & 0xFFFFFFFF]
        self.library, self.byte_of = None, {}
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    # merging -----------------------------------------------------------------------------------

    def merge(self, part: list[int]) -> list[int]:
        """All merges of a token sequence: earliest rule first, leftmost first among equals."""
        return self._merge_few(part) if len(part) <= FEW else self._merge_many(part)

    def _merge_few(self, part: list[int]) -> list[int]:
        """Keeps the neighbours' ranks in a list: quickest for common words."""
        rule, product = self.rule.get, self.product
        part = list(part)
        ranks = [rule(a << 32 | b, NO_RULE) for a, b in zip(part, part[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RULE:
                break
            at = ranks.index(least)
            part[at] = new = product[least]
            del part[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rule(part[at - 1] << 32 | new, NO_RULE)
            if at < len(ranks):
                ranks[at] = rule(new << 32 | part[at + 1], NO_RULE)
        return part

    def _merge_many(self, part: list[int]) -> list[int]:
        """Keeps the neighbours in a heap: n log n."""
        rule, product, n = self.rule.get, self.product, len(part)
        token, after, before = list(part), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(part, part[1:])) if (r := rule(a << 32 | b, NO_RULE)) != NO_RULE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if token[i] >= 0 else n
            if j >= n or rule(token[i] << 32 | token[j], NO_RULE) != rank:
                continue                                         # one of the two has changed since
            token[i], token[j] = product[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = rule(token[i] << 32 | token[k], NO_RULE)
                if r != NO_RULE:
                    heapq.heappush(heap, (r, i))
            k = before[i]
            if k >= 0:
                r = rule(token[k] << 32 | token[i], NO_RULE)
                if r != NO_RULE:
                    heapq.heappush(heap, (r, k))
        return [t for t in token if t >= 0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Code of two neighbouring stretches of a word, given the code of each."""
        if not left or not right:
            return left + right
        x = y = WINDOW
        while True:
            a, b = left[-x:], right[:y]
            window = self.merge([s for t in a + b for s in self.symbols[t]])
            left_agrees = x >= len(left) or window[0] == a[0]
            right_agrees = y >= len(right) or window[-1] == b[-1]
            if left_agrees and right_agrees:
                return left[:-x] + window + right[y:]
            x, y = x if left_agrees else 2 * x, y if right_agrees else 2 * y

    def joined(self, parts: list[list[int]]) -> list[int]:
        """Pairwise joins up a tree."""
        while len(parts) > 1:
            parts = [self.join(*parts[k:k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def leaf(self, raw: bytes, last: bool) -> list[int]:
        """Code of a stretch of a word's bytes; ``last`` if the word ends with it."""
        part = [self.inner[c] for c in raw]
        if last and part:
            part[-1] = self.final[raw[-1]]
        if len(part) <= LEAF:
            return self.merge(part)
        return self.joined([self.merge(part[k:k + LEAF]) for k in range(0, len(part), LEAF)])

    def word(self, word: str) -> bytes:
        """Packed ids of a word."""
        out = packed(self.leaf(word.encode("utf-8"), True))
        if len(word) <= CACHE_WORD_CHARS:
            if self.cached > CACHE_BYTES:
                self.cache.clear()
                self.cached = 0
            self.cache[word] = out
            self.cached += 200 + 4 * len(word) + len(out)
        return out

    # texts -------------------------------------------------------------------------------------

    def _library_words(self, text: str) -> list[str]:
        """Words as the tokenizers library normalises and splits them."""
        from tokenizers import Tokenizer

        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
            self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in w).decode("utf-8") for w, _ in split]

    def words(self, texts: list[str]) -> list[list[Word]]:
        """Words and special ids of each text in order."""
        stretch, owner, special = [], [], []                     # plain stretches; the special id after each
        for t, text in enumerate(texts):
            at = 0
            for m in self.special_at.finditer(text) if self.special_at and self.special_mark in text else ():
                stretch.append(text[at:m.start()])
                owner.append(t)
                special.append(self.special[m.group()])
                at = m.end()
            stretch.append(text[at:])
            owner.append(t)
            special.append(None)
        strange = [not s.isascii() and bool(unknown()[np.frombuffer(s.encode("utf-32-le"), np.uint32)].any()) for s in stretch]
        known = ["" if odd else normalised(s) for s, odd in zip(stretch, strange)]
        joined = "\n".join(known)
        begins, ends = spans(joined)
        upto = np.searchsorted(begins, np.cumsum([len(s) + 1 for s in known])).tolist()
        begins, ends = begins.tolist(), ends.tolist()
        out: list[list[Word]] = [[] for _ in texts]
        a = 0
        for s, odd, t, mark, b in zip(stretch, strange, owner, special, upto):
            out[t] += self._library_words(s) if odd else [joined[x:y] for x, y in zip(begins[a:b], ends[a:b])]
            if mark is not None:
                out[t].append(mark)
            a = b
        return out

    def encode_words(self, words: list[Word]) -> bytes:
        get, miss = self.cache.get, self.word
        return b"".join([(get(w) or miss(w)) if isinstance(w, str) else packed([w]) for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian uint32 ids of each text."""
        return [self.encode_words(w) for w in self.words(texts)]

    def decode(self, ids: bytes) -> str:
        """The tokens' names with a blank between them, special tokens included."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# Spark -------------------------------------------------------------------------------------------

Finish = Callable[["Vocabulary", "list[bytes]"], "dict[str, pa.Array]"]

PART = T.StructType([T.StructField("row", T.LongType()), T.StructField("place", T.IntegerType()),
                     T.StructField("words", T.ArrayType(T.StringType())), T.StructField("leaf", T.BinaryType()),
                     T.StructField("last", T.BooleanType())])


def _parts(v: Vocabulary, text: str) -> Iterator[tuple[list[str] | None, bytes | None, bool]]:
    """Blocks of whole words (a special token is its id in digits after a blank, which no word holds)
    and leaves of words longer than a block, in order."""
    block, size = [], 0
    for w in v.words([text])[0]:
        if isinstance(w, str) and len(w) > BLOCK_CHARS:
            if block:
                yield block, None, True
            block, size = [], 0
            raw = w.encode("utf-8")
            for k in range(0, len(raw), BLOCK_CHARS):
                yield None, raw[k:k + BLOCK_CHARS], k + BLOCK_CHARS >= len(raw)
            continue
        block.append(w if isinstance(w, str) else f" {w}")
        size += len(block[-1])
        if size >= BLOCK_CHARS:
            yield block, None, True
            block, size = [], 0
    yield block, None, True


def _spread(texts: DataFrame, vocab_path: str, schema: T.StructType, finish: Finish) -> DataFrame:
    """``finish`` of very long texts: rows of (kept, text) are cut, encoded part by part and joined in
    order, a text's codes in one task."""
    kept = texts.schema["kept"]
    cut_schema = T.StructType([*PART.fields, T.StructField("kept", kept.dataType)])

    def cut(batches):
        v = vocabulary(vocab_path)
        for batch in batches:
            for k, (row, text) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text").to_pylist())):
                for place, (words, leaf, last) in enumerate(_parts(v, text)):
                    own = pa.array([None if place else k], pa.int64())      # the other columns travel once
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([place], pa.int32()), pa.array([words], pa.list_(pa.string())),
                         pa.array([leaf], pa.binary()), pa.array([last]), batch.column("kept").take(own)], names=cut_schema.names)

    def coded(batches):
        v = vocabulary(vocab_path)
        for batch in batches:
            ids = [packed(v.leaf(leaf, last)) if words is None
                   else v.encode_words([int(w) if w[0] == " " else w for w in words])
                   for words, leaf, last in zip(*(batch.column(c).to_pylist() for c in ("words", "leaf", "last")))]
            whole = pa.array([w is not None for w in batch.column("words").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("place"), whole, pa.array(ids, pa.binary()),
                                              batch.column("last"), batch.column("kept")],
                                             names=["row", "place", "whole", "ids", "last", "kept"])

    def collected(batches):
        v = vocabulary(vocab_path)
        row, mine, out, leaves = None, None, [], []

        def done():
            return with_columns(pa.RecordBatch.from_struct_array(mine), finish(v, [b"".join(out)]))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("row", "whole", "ids", "last")]
            for k, (r, whole, ids, last) in enumerate(zip(*cols)):
                if r != row:
                    if row is not None:
                        yield done()
                    row, mine, out, leaves = r, batch.column("kept").slice(k, 1), [], []
                if whole:
                    out.append(ids)
                    continue
                leaves.append(np.frombuffer(ids, "<u4").tolist())
                if last:
                    out.append(packed(v.joined(leaves)))
                    leaves = []
        if row is not None:
            yield done()

    code_schema = T.StructType([*PART.fields[:2], T.StructField("whole", T.BooleanType()), T.StructField("ids", T.BinaryType()),
                                PART["last"], T.StructField("kept", kept.dataType)])
    parts = texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(trimmed(cut), cut_schema)
    parts = written(parts, "word-bpe-parts")                     # the row numbers are fixed here
    codes = parts.repartition("row", "place").mapInArrow(trimmed(coded), code_schema)
    return codes.repartition("row").sortWithinPartitions("row", "place").mapInArrow(trimmed(collected), schema)


def _applied(df: DataFrame, vocab_path: str, text_col: str, keep: list[str], new: list[T.StructField],
             finish: Finish) -> DataFrame:
    """Columns ``keep`` of every row and ``finish`` of its text's ids."""
    prepared(df)
    keep = [c for c in keep if c not in {f.name for f in new}]
    rows = df.select(F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.struct(F.lit(0).alias("_")).alias("kept"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([*rows.schema["kept"].dataType.fields, *new])

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(vocab_path)
        return with_columns(pa.RecordBatch.from_struct_array(piece.column("kept")), finish(v, v.encode(piece.column("text").to_pylist())))

    long = F.char_length("text") > SPREAD_CHARS
    short = rows.where(~long).mapInArrow(map_pieces(run, "text"), schema)
    return short.unionByName(_spread(rows.where(long), vocab_path, schema, finish)).select(*keep, *[f.name for f in new])


def encode(df: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """Adds ``ids_col`` (binary: packed little-endian uint32 ids of the text)."""
    return _applied(df, vocab_path, text_col, df.columns, [T.StructField(ids_col, T.BinaryType())],
                    lambda v, ids: {ids_col: pa.array(ids, pa.binary())})


def decode(df: DataFrame, vocab_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col``: the text the ids are decoded to; null ids decode to the empty text."""
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(vocab_path)
        return with_columns(piece, {out_col: pa.array([v.decode(b or b"") for b in piece.column(ids_col).to_pylist()], pa.string())})

    schema = T.StructType([*(f for f in df.schema.fields if f.name != out_col), T.StructField(out_col, T.StringType())])
    return prepared(df).mapInArrow(map_pieces(run, ids_col), schema)


def round_trip_report(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the text decoded from them, of every document;
    encoded, decoded and digested in one pass, so that neither ids nor decoded text leave the task."""
    def digest(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def finish(v: Vocabulary, ids: list[bytes]) -> dict[str, pa.Array]:
        return {"n_tokens": pa.array([len(b) // 4 for b in ids], pa.int64()),
                "ids_sha256": pa.array([digest(b) for b in ids]),
                "decoded_sha256": pa.array([digest(v.decode(b).encode("utf-8")) for b in ids])}

    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
           T.StructField("decoded_sha256", T.StringType())]
    return _applied(docs, vocab_path, "text", ["doc_id"], new, finish)
