"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles are joined when their Jaccard similarity reaches ``percent``. Sizes fall into
bands so that joinable sets lie in one band or in neighbouring ones; a set is signed for its own band
and, as the smaller partner, for the next. In a band all joinable pairs differ in at most ``far``
elements. The feature domain is cut into ``parts``, each into ``cells``; by the pigeonhole principle
at least ``1 + spare`` parts differ in at most ``near`` cells, and for every choice of the remaining
cells there is one signature, so in each such part the two sets share one.

The spare parts keep the guarantee while two things are left out of the exchange:
* signatures of empty cells, which would meet in every document - unless a set has more parts with
  such a signature than are spare; then it sends them as well;
* very common signatures (those of passages many documents share): a set may drop its most frequent
  signatures as long as they lie in at most ``spare`` parts, less those with a signature of empty
  cells. The least frequent of a pair's common signatures cannot be dropped by either, because
  ``spare`` more frequent ones in other parts would have to be dropped before it.

Work per document is vectorised; signatures are shuffled as packed pieces, one per task and bucket,
in which equal sets of a task already count once. Documents with equal sets form a class; only
classes meet. Inside a group of classes with one signature, not all pairs are formed: first a star
around the class with the most groups is checked; then, only across the components this gives, pairs
that pass a size test and a cell-agreement test (both necessary for a link) are checked against the
full sets. So every link between different components is looked at, and links inside a component are
not needed for the result.

Defined cases: a null or empty text, or one of separators only, has the empty set and is linked with
nothing; fewer than five words make one shingle of the whole sequence; repeated rows are equal sets
and link; ids may repeat; a null id is kept (as the smallest of its component it gives way to any
other id); extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_schema, map_pieces, mix64, pieces, prepared, trimmed, utf8, with_columns, written
from .graph import components
from .shingles import shingle_sets

PERCENT = 80
TASK_SIGNATURES = 2_000_000     # signatures aimed at per bucket
FLUSH_SIGNATURES = 600_000    # signatures a task packs at once
FLUSH_SETS = 32_000             # and the most sets, so that a set's number fits 15 bits
BROADCAST_IDS = 300_000         # ids broadcast at most when texts are fetched again
BLOCK = 2048                    # classes of a signature group compared in one block
PART_LIMIT = 1 << 16
SKETCH_CELLS = 512              # cells of a sketch, unless the band's scheme has more


@dataclass(frozen=True)
class Scheme:
    tag: int
    parts: int
    cells: int
    spare: int
    pick: np.ndarray             # cells x signatures: the cells a signature covers


@lru_cache(maxsize=None)
def bands(percent: int = PERCENT, up_to: int = 1 << 30) -> np.ndarray:
    """Lowest size of every band."""
    out, low = [], 1
    while low <= up_to:
        out.append(low)
        low = low * 100 // percent + 1
    return np.array(out, np.int64)


@lru_cache(maxsize=None)
def scheme(tag: int, percent: int = PERCENT) -> Scheme:
    high = int(bands(percent)[tag + 1]) - 1
    far = 2 * high * (100 - percent) // (100 + percent)      # largest symmetric difference
    if far <= 5:                 # one part, all ways to leave ``far`` cells out
        parts, near, spare = 1, far, 0
        cells = far + 3 if far else 1
    elif far <= 30:
        near, spare, cells = 2, 1, 5
        parts = -(-(far + 1) // 3) + spare
    else:
        near, cells = 1, 3
        parts = -(-(far + 1) // 2)
        spare = 2 + parts // 8
        parts += spare
    chosen = list(combinations(range(cells), cells - near))
    pick = np.zeros((cells, len(chosen)), np.uint64)
    for j, c in enumerate(chosen):
        pick[list(c), j] = 1
    return Scheme(tag, parts, cells, spare, pick)


@lru_cache(maxsize=4096)
def _edges(n: int) -> np.ndarray:
    return np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)


@lru_cache(maxsize=4096)
def _places(tag: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(salt, part) of every signature of a scheme."""
    s = scheme(tag, percent)
    n = s.parts * s.pick.shape[1]
    part = np.repeat(np.arange(s.parts, dtype=np.uint64), s.pick.shape[1])
    return mix64(np.arange(n, dtype=np.uint64) + np.uint64(tag << 40)), part


def cells_of(s: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash sum, count) of the ``n`` cells of a sorted set; ``hashed`` are running sums."""
    edge = np.empty(n + 1, np.int64)
    edge[0], edge[n] = 0, len(s)
    edge[1:n] = np.searchsorted(s, _edges(n))
    at = hashed[edge]
    return at[1:] - at[:-1], edge[1:] - edge[:-1]


def running(s: np.ndarray) -> np.ndarray:
    out = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix64(s ^ np.uint64(0x5851F42D4C957F2D)), out=out[1:])
    return out


def signatures(s: np.ndarray, hashed: np.ndarray, tag: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, int]:
    """(signature hash, part) of one set for one band, and how many of its spare parts are spent on
    empty cells: all where it sends such signatures too, for its partner may leave them out."""
    sch = scheme(tag, percent)
    total, count = cells_of(s, hashed, sch.parts * sch.cells)
    salt, part = _places(tag, percent)
    sig = mix64((total.reshape(sch.parts, sch.cells) @ sch.pick).ravel() + salt)
    full = count.reshape(sch.parts, sch.cells) @ sch.pick.astype(np.int64) > 0
    spent = int((~full.all(1)).sum())
    if spent <= sch.spare:
        full = full.ravel()
        return sig[full], part[full], spent
    return sig, part, sch.spare


def sketch(s: np.ndarray, hashed: np.ndarray, tag: int, percent: int = PERCENT) -> bytes:
    """One byte per cell: two sets that differ in d elements agree in all but d cells. The more cells
    there are for the band's largest difference, the fewer pairs beyond the threshold pass."""
    sch = scheme(tag, percent)
    total, _ = cells_of(s, hashed, max(sch.parts * sch.cells, min(SKETCH_CELLS, 8 * sch.parts * sch.cells)))
    return (mix64(total) & np.uint64(0xFF)).astype(np.uint8).tobytes()


def class_of(hashed: np.ndarray, size: int) -> int:
    """64-bit name of a set (signed), from the sum of its hashes and its size."""
    with np.errstate(over="ignore"):
        return int(mix64(np.array([hashed[-1] + np.uint64(size) * np.uint64(0x9E3779B97F4A7C15)], np.uint64)).view(np.int64)[0])


# ---- packed pieces: the signatures of many sets that fall into one bucket -------------------------

def pack(key: np.ndarray, ref: np.ndarray, cls: np.ndarray, band: np.ndarray, spent: np.ndarray | None = None) -> bytes:
    """``key`` (48 bits) sorted, ``ref`` = 2 * set number + own-band flag, ``spent`` by ``ref``. Only
    sets that occur are kept; keys are stored as differences, byte plane by byte plane, which the
    shuffle compresses."""
    used, number = np.unique(ref >> 1, return_inverse=True)
    step = np.diff(key, prepend=np.uint64(0)).astype("<u8")
    planes = step.view(np.uint8).reshape(-1, 8)[:, :6].T
    head = np.array([len(key), len(used)], "<u4")
    return b"".join((head.tobytes(), np.ascontiguousarray(planes).tobytes(),
                     ((number << 1) | (ref & 1)).astype("<u2").tobytes(),
                     cls[used].astype("<i8").tobytes(), band[used].astype(np.uint8).tobytes(),
                     b"" if spent is None else spent.reshape(-1, 2)[used].astype("<u2").tobytes()))


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, own flag, class, band) per signature."""
    n, m = np.frombuffer(blob, "<u4", 2).tolist()
    at = 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, at).reshape(6, n).T
    key = np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64)
    at += 6 * n
    ref = np.frombuffer(blob, "<u2", n, at)
    at += 2 * n
    cls = np.frombuffer(blob, "<i8", m, at)
    band = np.frombuffer(blob, np.uint8, m, at + 8 * m)
    return key, (ref & 1).astype(bool), cls[ref >> 1], band[ref >> 1]


def unpack_spent(blob: bytes) -> np.ndarray:
    """Spent parts per signature."""
    n, m = np.frombuffer(blob, "<u4", 2).tolist()
    return np.frombuffer(blob, "<u2", 2 * m, 8 + 8 * n + 9 * m)[np.frombuffer(blob, "<u2", n, 8 + 6 * n)]


SENT = "bucket int, id long, n long, cls long, piece binary"
_FOUND = "kind int, id long, n long, cls long, sig long, tag int, part int, own boolean, freq long, spent int"


def _send(labels: list[int], percent: int):
    """Task function: documents in, their classes and the packed signatures out."""
    name = np.array(labels, np.int32)
    count = len(labels)

    def run(batches):
        sigs, parts, refs, cls, band, spent, seen, total = [], [], [], [], [], [], {}, 0

        def flush():
            nonlocal sigs, parts, refs, cls, band, spent, seen, total
            if sigs:
                sig = np.concatenate(sigs)
                bucket = ((sig >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
                key = (np.concatenate(parts).astype(np.uint64) << np.uint64(32)) | (sig & np.uint64(0xFFFFFFFF))
                order = np.lexsort((key, bucket))
                key, ref, bucket = key[order], np.concatenate(refs)[order], bucket[order]
                c, s, left = np.array(cls, np.int64), np.array(band, np.uint8), np.array(spent, np.uint16)
                edge = np.searchsorted(bucket, np.arange(count + 1, dtype=np.uint64))
                for a in range(0, count, 16):
                    which = [b for b in range(a, min(a + 16, count)) if edge[b + 1] > edge[b]]
                    blobs = [pack(key[edge[b]:edge[b + 1]], ref[edge[b]:edge[b + 1]], c, s, left) for b in which]
                    none = pa.nulls(len(which), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(name[which]), none, none, none, pa.array(blobs, pa.binary())],
                                                     names=["bucket", "id", "n", "cls", "piece"])
            sigs, parts, refs, cls, band, spent, seen, total = [], [], [], [], [], [], {}, 0

        for batch in batches:
            for p in pieces(batch, "text"):
                raw, off = utf8(p.column("text"))
                sets, bounds = shingle_sets(raw, off)
                tags = np.searchsorted(bands(percent), np.diff(bounds), "right") - 1
                names = np.zeros(p.num_rows, np.int64)
                for i in range(p.num_rows):
                    s = sets[bounds[i]:bounds[i + 1]]
                    if len(s) == 0:
                        continue
                    hashed = running(s)
                    c = names[i] = class_of(hashed, len(s))
                    if c in seen:                       # equal sets of one task are sent once
                        continue
                    if len(cls) >= FLUSH_SETS or total >= FLUSH_SIGNATURES:
                        yield from flush()
                    number = seen[c] = len(cls)
                    cls.append(c)
                    band.append(int(tags[i]))
                    for tag, own in ((int(tags[i]) + 1, 0), (int(tags[i]), 1)):
                        sig, part, empty = signatures(s, hashed, tag, percent)
                        spent.append(min(empty, PART_LIMIT - 1))
                        sigs.append(sig)
                        parts.append(np.minimum(part, PART_LIMIT - 1).astype(np.uint16))
                        refs.append(np.full(len(sig), 2 * number + own, np.int32))
                        total += len(sig)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[(names % count).astype(np.int64)]), p.column("id").cast(pa.int64()), pa.array(np.diff(bounds)),
                     pa.array(names, mask=np.diff(bounds) == 0), pa.nulls(p.num_rows, pa.binary())],
                    names=["bucket", "id", "n", "cls", "piece"])
        yield from flush()
    return run


def _meet(percent: int):
    """Task function: the signatures of whole buckets in, those that several classes share out."""
    names = [x.split()[0] for x in _FOUND.split(", ")]

    def run(batches):
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            piece = batch.column("piece")
            plain = batch.filter(piece.is_null())
            if plain.num_rows:
                n = plain.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), plain.column("id"), plain.column("n"), plain.column("cls"), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.int32())], names=names)
            rest = batch.filter(piece.is_valid())
            for b, x in zip(rest.column("bucket").to_pylist(), rest.column("piece").to_pylist()):
                blobs.setdefault(b, []).append(x)
        for b in sorted(blobs):
            got = [(*unpack(x), unpack_spent(x)) for x in blobs.pop(b)]
            key, own, cls, tag, spent = (np.concatenate(x) for x in zip(*got))
            del got
            tag = tag + ~own                              # the next band where the set is the smaller partner
            order = np.argsort(key, kind="stable")
            k = key[order]
            new = np.empty(len(k), bool)
            new[0] = True
            np.not_equal(k[1:], k[:-1], out=new[1:])
            lonely = new.copy()
            lonely[:-1] &= new[1:]
            order = order[~lonely]                       # signatures that occur more than once
            frame = pd.DataFrame({"key": key[order], "tag": tag[order], "cls": cls[order], "own": own[order],
                                  "spent": spent[order]})
            frame = frame.drop_duplicates(["key", "tag", "cls"])
            by = frame.groupby(["key", "tag"], sort=False)
            frame["freq"] = by["cls"].transform("size")
            frame = frame[(frame["freq"] > 1) & by["own"].transform("any")]
            key = frame["key"].to_numpy()
            sig = mix64(key + (np.uint64(b) << np.uint64(48))) ^ frame["tag"].to_numpy().astype(np.uint64)
            n = len(frame)
            for a in range(0, n, 50_000):
                f = frame.iloc[a:a + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(f), np.int32)), pa.nulls(len(f), pa.int64()), pa.nulls(len(f), pa.int64()),
                     pa.array(f["cls"].to_numpy()), pa.array(sig[a:a + 50_000].view(np.int64)), pa.array(f["tag"].to_numpy(np.int32)),
                     pa.array((key[a:a + 50_000] >> np.uint64(32)).astype(np.int32)), pa.array(f["own"].to_numpy()),
                     pa.array(f["freq"].to_numpy(np.int64)), pa.array(f["spent"].to_numpy(np.int32))], names=names)
    return run


def even_labels(spark, n: int) -> list[int]:
    """``n`` bucket names that ``repartition(n, name)`` deals to ``n`` different partitions."""
    rows = (spark.range(0, 12 * n).select(F.col("id").cast("int").alias("id")).withColumn("p", F.pmod(F.hash("id"), F.lit(n)))
            .groupBy("p").agg(F.min("id").alias("id")).collect())
    have = [r.id for r in rows]
    spare = [i for i in range(12 * n, 13 * n)]
    return sorted(have + spare[:n - len(have)])


def met(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Written table with a row per document (kind 0) and per class in a shared signature (kind 1)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // (6 * TASK_SIGNATURES)))           # about one signature per word
    labels = even_labels(docs.sparkSession, buckets)
    sent = prepared(rows).mapInArrow(trimmed(_send(labels, percent)), SENT).repartition(buckets, "bucket")
    return written(sent.mapInArrow(trimmed(_meet(percent)), _FOUND), "jaccard-met")


def spares(percent: int) -> list[int]:
    """Parts a set may leave out, per band: up to the first band with as many parts as numbers for
    them, from which on all signatures stay."""
    out = []
    for t in range(len(bands(percent)) - 1):
        if scheme(t, percent).parts >= PART_LIMIT:
            break
        out.append(scheme(t, percent).spare)
    return out


def band_of(n: Column, percent: int) -> Column:
    """Band number of a size."""
    out = F.lit(0)
    for low in bands(percent)[1:].tolist():
        out = out + F.when(n >= low, 1).otherwise(0)
    return out


def thinned(found: DataFrame, percent: int) -> DataFrame:
    """``sig, cls, tag``: without the most frequent signatures every set may drop."""
    spare = F.array(*[F.lit(s) for s in spares(percent)])
    # parts met so far, from the most frequent signature on: a part is counted at its first one
    one = Window.partitionBy("cls", "tag")
    inside, before = one.orderBy("part", F.desc("freq"), "sig"), one.orderBy(F.desc("freq"), "sig")
    first = F.when(F.lag("part").over(inside) == F.col("part"), 0).otherwise(1)
    rows = (found.where("kind = 1").withColumn("first", first)
            .withColumn("parts", F.sum("first").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .where(F.col("parts") > F.coalesce(F.get(spare, F.col("tag")), F.lit(0)) - F.col("spent")))
    rows = rows.select("sig", "cls", "tag", "own")
    # near copies share many signatures: of the groups with the same members one is enough
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "cls")).alias(f"m{seed}")
    live = (rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.max("own").alias("o"), mark(1), mark(2)).where("c > 1 and o")
            .groupBy("c", "m1", "m2").agg(F.min("sig").alias("sig")).select("sig"))
    return written(rows.join(live, "sig").select("sig", "cls", "tag"), "jaccard-members")


def needed_sets(docs: DataFrame, found: DataFrame, members: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Written ``cls, n, words, own, next``: the full set and both sketches of every class in a group.
    The texts are read again for one document per class, and for all without an id if a class has no other."""
    one = (found.where("kind = 0 and cls is not null").groupBy("cls").agg(F.min("id").alias("id"))
           .join(members.select("cls").distinct(), "cls"))
    one = written(one, "jaccard-needed")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ids = one.where("id is not null").select("id").distinct()
    n, named = one.agg(F.count(F.lit(1)), F.count("id")).first()
    some = rows.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "id", "left_semi")
    rows = some if n == named else some.unionByName(rows.where("id is null"))
    schema = "cls long, n long, words binary, own binary, next binary"

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "text"):
                raw, off = utf8(p.column("text"))
                sets, bounds = shingle_sets(raw, off)
                tags = np.searchsorted(bands(percent), np.diff(bounds), "right") - 1
                out = []
                for i in range(p.num_rows):
                    s = sets[bounds[i]:bounds[i + 1]]
                    if len(s):
                        h = running(s)
                        t = int(tags[i])
                        out.append((class_of(h, len(s)), len(s), s.tobytes(), sketch(s, h, t, percent), sketch(s, h, t + 1, percent)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["cls", "n", "words", "own", "next"])

    sets = prepared(rows).mapInArrow(trimmed(run), schema)
    return written(sets.join(members.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"]), "jaccard-sets")


def could_link(n_a, sk_a, n_b, sk_b, percent: int) -> np.ndarray:
    """Necessary test: sizes, and enough agreeing cells, for arrays of pairs (rows of sketches)."""
    n_a, n_b = np.asarray(n_a), np.asarray(n_b)
    sizes = (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))
    far = (n_a + n_b) * (100 - percent) // (100 + percent)
    agree = np.count_nonzero(sk_a == sk_b, axis=-1)
    return sizes & (agree >= sk_a.shape[-1] - far)


def _whole_groups(batches, keys: tuple[str, ...]):
    """Tables of complete groups from batches sorted by ``keys``: a group cut by a batch's end waits
    for the rest."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        last = np.ones(t.num_rows, bool)
        for k in keys:
            v = t.column(k).to_numpy()
            last &= v == v[-1]
        cut = int(last.argmax())
        held = t.slice(cut)
        if cut:
            yield t.slice(0, cut)
    if held is not None:
        yield held


def _columns(t: pa.Table, names: tuple[str, ...]) -> list[np.ndarray]:
    return [t.column(n).to_numpy() for n in names]


def _sketches(t: pa.Table, at: np.ndarray) -> np.ndarray:
    """The rows' sketches as a matrix; all are of one band and so of one length."""
    raw, _ = utf8(t.column("sk").take(pa.array(at)))
    return raw.reshape(len(at), -1)


def _pairs(*columns: list) -> pa.RecordBatch:
    """Distinct rows of (a, b, ...) integer columns given in pieces."""
    rows = pd.DataFrame({n: np.concatenate(c) if c else np.zeros(0, np.int64) for n, c in zip(("a", "b", "deg"), columns)})
    rows = rows.drop_duplicates(["a", "b"])
    return pa.RecordBatch.from_arrays([pa.array(rows[c].to_numpy(np.int64)) for c in rows], names=list(rows))


def _star_pairs(percent: int):
    """Task function over rows sorted by (tag, sig, slice): the hub (a) with every other class (b) of
    its group slice that could link with it."""
    def run(batches):
        for t in _whole_groups(batches, ("tag", "sig", "slice")):
            tag, sig, piece, cls, n, hub, deg = _columns(t, ("tag", "sig", "slice", "cls", "n", "is_hub", "deg"))
            new = np.ones(len(tag), bool)
            new[1:] = (tag[1:] != tag[:-1]) | (sig[1:] != sig[:-1]) | (piece[1:] != piece[:-1])
            group = np.cumsum(new) - 1
            hub_row = np.full(group[-1] + 1, -1)
            rows = np.flatnonzero(hub)
            hub_row[group[rows]] = rows
            a, b, d = [], [], []
            for g in np.unique(tag):
                at = np.flatnonzero(tag == g)
                sk = _sketches(t, at)
                h = hub_row[group[at]]
                ok = (h >= 0) & (cls[at] != cls[h])
                mine, theirs = np.flatnonzero(ok), np.searchsorted(at, h[ok])
                good = could_link(n[at[theirs]], sk[theirs], n[at[mine]], sk[mine], percent)
                a.append(cls[at[theirs[good]]])
                b.append(cls[at[mine[good]]])
                d.append(deg[at[theirs[good]]])
            yield _pairs(a, b, d)
    return run


def _cross_pairs(percent: int):
    """Task function over rows sorted by (tag, sig, i, j): pairs of classes of different components
    that could link; a block with another one gives only pairs across the two. Rows of all groups
    are compared with the row ``d`` places on, for growing ``d``."""
    def run(batches):
        for t in _whole_groups(batches, ("tag", "sig", "i", "j")):
            tag, sig, i, j, cls, n, root, side = _columns(t, ("tag", "sig", "i", "j", "cls", "n", "root", "side"))
            new = np.ones(len(tag), bool)
            new[1:] = (tag[1:] != tag[:-1]) | (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            group = np.cumsum(new)
            a, b = [], []
            for g in np.unique(tag):
                at = np.flatnonzero(tag == g)
                sk = _sketches(t, at)
                gr, ro, si, cl, nn = group[at], root[at], side[at], cls[at], n[at]
                two = i[at] != j[at]
                left, d = np.arange(len(at)), 0
                while len(left):
                    d += 1
                    left = left[left + d < len(at)]
                    left = left[gr[left] == gr[left + d]]
                    right = left + d
                    test = (ro[left] != ro[right]) & (~two[left] | (si[left] != si[right]))
                    x, y = left[test], right[test]
                    ok = could_link(nn[x], sk[x], nn[y], sk[y], percent)
                    if ok.any():
                        a.append(np.minimum(cl[x[ok]], cl[y[ok]]))
                        b.append(np.maximum(cl[x[ok]], cl[y[ok]]))
            yield _pairs(a, b)
    return run


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets meet the threshold: 100 * intersection >= percent * union."""
    words = sets.select("cls", "words")
    rows = (pairs.join(words.select(F.col("cls").alias("b"), F.col("words").alias("wb")), "b")
            .join(words.select(F.col("cls").alias("a"), F.col("words").alias("wa")), "a"))

    def run(batches):
        for batch in batches:
            for p in pieces(batch, "wa", 32_000_000):
                keep = np.zeros(p.num_rows, bool)
                last, base = None, None
                for i in range(p.num_rows):
                    wa = p.column("wa")[i].as_buffer()
                    if last is None or not last.equals(wa):
                        last, base = wa, np.frombuffer(wa, np.uint64)
                    other = np.frombuffer(p.column("wb")[i].as_buffer(), np.uint64)
                    at = np.searchsorted(base, other)
                    at[at == len(base)] = 0
                    both = int((base[at] == other).sum())
                    keep[i] = 100 * both >= percent * (len(base) + len(other) - both)
                yield pa.RecordBatch.from_arrays([p.column("a"), p.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return written(rows.select("a", "b", "wa", "wb").mapInArrow(trimmed(run), "a long, b long"), "jaccard-links")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(``id, n, cls`` per document, ``node, root`` of the classes that link with another class)."""
    found = met(docs, id_col, text_col, percent)
    members = thinned(found, percent)
    sets = needed_sets(docs, found, members, id_col, text_col, percent)
    sk = sets.select("cls", "n", "own", "next")
    sk = sk.withColumn("band", band_of(F.col("n"), percent))
    sk = (sk.select("cls", "n", F.col("band").alias("tag"), F.col("own").alias("sk"))
          .unionByName(sk.select("cls", "n", (F.col("band") + 1).alias("tag"), F.col("next").alias("sk"))))
    sk = written(sk, "jaccard-sketches")

    degree = members.groupBy("cls").agg(F.count(F.lit(1)).alias("deg"))
    hubs = (members.select("sig", "cls").join(degree, "cls").groupBy("sig")
            .agg(F.max(F.struct("deg", "cls")).alias("hub"), F.count(F.lit(1)).alias("m"))
            .select("sig", "hub.deg", F.col("hub.cls").alias("hub"), "m"))
    hubs = written(hubs, "jaccard-hubs")
    # stage 1: a group's rows in slices, the hub in each of them
    slices = F.ceil(F.col("m") / BLOCK).cast("int")
    spread = members.join(hubs, "sig").withColumn("is_hub", F.col("cls") == F.col("hub")).withColumn(
        "slice", F.explode(F.when(F.col("is_hub"), F.sequence(F.lit(0), slices - 1))
                           .otherwise(F.array(F.pmod(F.hash("cls"), slices)))))
    # the sketches join last: what goes before moves a few numbers per row
    spread = spread.select("tag", "sig", "slice", "cls", "is_hub", "deg").join(sk, ["cls", "tag"])
    spread = (spread.select("tag", "sig", "slice", "cls", "n", "sk", "is_hub", "deg").repartition("tag", "sig", "slice")
              .sortWithinPartitions("tag", "sig", "slice"))
    stars = prepared(spread).mapInArrow(trimmed(_star_pairs(percent)), "a long, b long, deg long")
    stars = written(stars.groupBy("a", "b").agg(F.max("deg").alias("deg")), "jaccard-stars")
    # first every class with the best of its hubs, then the other hubs that are still apart from it
    best = stars.groupBy("b").agg(F.max(F.struct("deg", "a"))["a"].alias("a"))
    best = written(best, "jaccard-best")
    first = linked(best, sets, percent)
    roots = components(first, "jaccard-roots")
    known = roots.select(F.col("node").alias("_cls"), "root")
    root_of = lambda d, c: (d.join(known.select(F.col("_cls").alias(c), F.col("root").alias(f"r{c}")), c, "left")
                            .withColumn(f"r{c}", F.coalesce(f"r{c}", c)))
    other = root_of(root_of(stars.join(best, ["a", "b"], "left_anti"), "a"), "b").where("ra <> rb").select("a", "b")
    other = linked(written(other, "jaccard-other"), sets, percent)
    if other.limit(1).count():
        first = first.unionByName(other)
        roots = components(first, "jaccard-roots")
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    # stage 2: groups that still hold several components, in blocks and pairs of blocks
    named = members.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = written(named.select("tag", "sig", "cls", "root"), "jaccard-named")
    mixed = (named.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("r0"), F.max("root").alias("r1"))
             .where("r0 <> r1").select("sig", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    cut = named.join(mixed, "sig").withColumn("side", F.pmod(F.hash("cls"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("tag", "sig", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                     "cls", "root", "side").join(sk, ["cls", "tag"])
    cut = (cut.select("tag", "sig", "i", "j", "cls", "n", "sk", "root", "side").repartition("tag", "sig", "i", "j")
           .sortWithinPartitions("tag", "sig", "i", "j"))
    across = cut.mapInArrow(trimmed(_cross_pairs(percent)), "a long, b long").distinct()
    across = written(across.join(stars, ["a", "b"], "left_anti"), "jaccard-across")      # not checked before
    second = linked(across, sets, percent)
    per_doc = found.where("kind = 0").select("id", "n", "cls")
    if second.limit(1).count():
        roots = components(first.unionByName(second), "jaccard-final")
    return per_doc, roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id`` (smallest id reachable by links)."""
    per_doc, roots = links(docs, id_col, text_col, percent)
    classes = (per_doc.where("cls is not null").groupBy("cls").agg(F.min("id").alias("least"))
               .join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    classes = written(classes, "jaccard-classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "root").select("cls", "component_id")
    return (per_doc.join(named, "cls", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every linked group, the smallest id (null ids last, then the
    smaller class); documents without shingles all stay. Texts are only filtered, by an anti join
    with the ids that go. Only where ids repeat or are missing are the texts' classes needed."""
    per_doc, roots = links(docs, id_col, text_col, percent)
    rows = per_doc.where("cls is not null").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rows = written(rows.select("id", "cls", F.coalesce("root", "cls").alias("root")), "jaccard-grouped")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "cls")
    heads = written(rows.groupBy("root").agg(F.min(order).alias("head")).select("root", "head.id", "head.cls"), "jaccard-heads")
    odd = per_doc.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").limit(1).count()
    key = F.col(id_col).cast("long")
    if not odd:
        lost = (rows.join(heads.select("root", F.col("id").alias("head")), "root").where("id <> head")
                .select(F.col("id").alias("_lost")))
        lost = written(lost, "jaccard-lost")
        few = lost.count() <= BROADCAST_IDS
        return docs.join(F.broadcast(lost) if few else lost, key == F.col("_lost"), "left_anti")
    named = with_class(docs.select(F.struct("*").alias("_row"), key.alias("_id"), F.col(text_col).cast("string").alias("_text")), "_text", "_class")
    kept = named.join(heads.select(F.col("id").alias("_head"), F.col("cls").alias("_class")), "_class").where(F.col("_id").eqNullSafe(F.col("_head")))
    one = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_class").orderBy("_text"))).where("_n = 1")
    return one.select("_row.*").unionByName(named.where("_class is null").select("_row.*"))


def with_class(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Adds the class of the text's shingle set, null for the empty set."""
    def run(p: pa.RecordBatch) -> pa.RecordBatch:
        sets, bounds = shingle_sets(*utf8(p.column(text_col)))
        names = [class_of(running(sets[a:b]), b - a) if b > a else None for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return with_columns(p, {out_col: pa.array(names, pa.int64())})

    return prepared(df).mapInArrow(map_pieces(run, text_col), add_schema(df, **{out_col: T.LongType()}))
