"""Audit of how document filters interact: count-weighted decision diagrams of failure masks.

Every document gets a mask with one bit per filter it fails. Spark counts the masks per part (and,
of those, the documents with a good or a toxic label), which leaves at most 2^k rows a part. Per
part a decision diagram is built from them: level by level it asks one filter, the two children are
the documents that pass and those that fail, and every node carries the counts of the documents
below it; equal nodes are stored once. Two neighbouring levels are exchanged without looking at the
documents again, and exchanges of neighbours alone lead through all k! orders, one each. In the
diagram of an order, the path on which everything passes holds the steps of that order: its nodes'
fail children are what each filter removes, its pass children what is kept.

Defined cases: a null text is empty; a null source is the part ''; an empty table has no rows. A row
with a null doc_id is never a later copy and makes no other row one, and has no label. Repeated rows
count as often as they occur; rows with the same id and text are not copies of each other. Where an id
has several labels, one that says 1 is enough. Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepared, written

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200                  # filter A
MIN_DISTINCT_PERCENT = 50        # filter B
MAX_UPPER_PERCENT = 2            # filter C
MARKS = r"[#$%&*|]"              # filter D
COPY = "E"                       # the filter that needs the whole table

WEIGHTS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that one text decides."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MAX_UPPER_PERCENT * F.char_length(text).cast("long"),
        "D": text.rlike(MARKS),
    }


def _bits(filters: Mapping[str, Column]) -> Column:
    total = F.lit(0)
    for bit, failing in enumerate(filters.values()):
        total = total + F.when(failing, 1 << bit).otherwise(0)
    return total.cast("int")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and failure mask; bit i is the i-th filter.

    Texts never leave the scan: rows of id, part, mask and digest meet the labels by id, are added up
    per (digest, part, mask, labels), and only these sums are compared with the smallest id of their
    digest. Sums are formed before each shuffle, so a text with a third of all rows is a few rows of
    every task; null ids are dealt by digest.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       _bits(text_filters(text)).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.withColumn("spread", F.lit(0).cast("long"))
    rows = rows.join(marks, ["doc_id", "spread"], "left").na.fill(0, ["good", "toxic"])

    group = ["digest", "part", "mask", "good", "toxic"]
    one = rows.groupBy("doc_id", "spread", *group).agg(F.count(F.lit(1)).alias("n"))
    # of each group the rows that carry its smallest id; nulls neither are copies nor make one
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    sums = one.groupBy(*group).agg(F.sum("n").alias("n"), F.min(known).alias("least"),
                                   F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    sums = written(sums, "filter-audit")                        # read twice below; texts are scanned once
    first = sums.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    sums = sums.join(first, "digest")
    original = F.col("nameless") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    copy_bit = 1 << len(text_filters(text))
    both = sums.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), original.alias("n")),
        F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - original).alias("n")))).alias("m"))
    n = F.col("m.n")
    return both.where(n > 0).groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


class Diagram:
    """Decision diagram over failure masks. ``order[level]`` is the filter asked at that level. A node
    is (pass child, fail child) and its weights are the sums below it; leaves hold weights alone, the
    empty leaf is 0. Equal nodes and equal leaves are shared."""

    def __init__(self, masks: Mapping[int, tuple[int, ...]], size: int):
        self.order = list(range(size))
        width = len(next(iter(masks.values()))) if masks else len(WEIGHTS)
        self.weights: list[tuple[int, ...]] = [(0,) * width]
        self.children: list[tuple[int, int] | None] = [None]
        self._known: dict[tuple, int] = {self.weights[0]: 0}
        layer = [self._leaf(masks.get(self._mask(i, size), self.weights[0])) for i in range(1 << size)]
        while len(layer) > 1:
            layer = [self._node(a, b) for a, b in zip(layer[::2], layer[1::2])]
        self.root = layer[0]

    @staticmethod
    def _mask(place: int, size: int) -> int:
        """Mask of a leaf: the first filter decides the highest bit of the leaf's place."""
        return sum(1 << i for i in range(size) if place >> (size - 1 - i) & 1)

    def _new(self, key: tuple, weights: tuple[int, ...], children: tuple[int, int] | None) -> int:
        if key not in self._known:
            self._known[key] = len(self.weights)
            self.weights.append(weights)
            self.children.append(children)
        return self._known[key]

    def _leaf(self, weights: tuple[int, ...]) -> int:
        return self._new(weights, weights, None)

    def _node(self, passed: int, failed: int) -> int:
        if not passed and not failed:
            return 0                                            # nobody gets here
        return self._new(("node", passed, failed),
                         tuple(map(sum, zip(self.weights[passed], self.weights[failed]))), (passed, failed))

    def _of(self, node: int) -> tuple[int, int]:
        return self.children[node] or (0, 0)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and ``level + 1``: below a node at ``level`` the four
        grandchildren change places, above it only the references change."""
        done: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if not node:
                return 0
            if node not in done:
                (a, b) = self._of(node)
                if depth < level:
                    done[node] = self._node(rebuilt(a, depth + 1), rebuilt(b, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self._of(a), self._of(b)
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, weights kept, weights removed) of each step on the path where everything passes."""
        node = self.root
        for asked in self.order:
            passed, failed = self._of(node)
            yield asked, self.weights[passed], self.weights[failed]
            node = passed


def neighbour_swaps(size: int) -> Iterator[int]:
    """Levels to exchange one after the other so that all orders of ``size`` filters are met once: the
    last filter walks through the others, which move one exchange on each time it reaches an end."""
    if size < 2:
        return
    down = True
    inner = neighbour_swaps(size - 1)
    while True:
        yield from (range(size - 2, -1, -1) if down else range(size - 1))
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down


def interactions(masks: Mapping[int, tuple[int, int, int]], names: str) -> Iterator[tuple]:
    """(order, step, *COUNTS) of every order and step for one part's (n, good, toxic) per mask."""
    size = len(names)
    failing = [sum(w[0] for m, w in masks.items() if m >> i & 1) for i in range(size)]
    alone = [masks.get(1 << i, (0, 0, 0))[0] for i in range(size)]
    diagram = Diagram(masks, size)
    shapley, rows = [0] * size, []
    swaps = neighbour_swaps(size)
    for _ in range(math.factorial(size)):
        order = "".join(names[i] for i in diagram.order)
        for step, (asked, kept, removed) in enumerate(diagram.all_pass(), 1):
            shapley[asked] += removed[0]
            rows.append((order, step, asked, kept[0], removed))
        level = next(swaps, None)
        if level is not None:
            diagram.swap(level)
    for order, step, asked, kept, (removed, good, toxic) in rows:
        yield (order, step, kept, removed, failing[asked] - removed, alone[asked], good, toxic, shapley[asked])


def audit(counts: DataFrame, names: str) -> DataFrame:
    """Every order and step per part, from ``failure_counts`` rows. A part is one row of at most
    2^len(names) masks, so the diagrams are spread over tasks by part."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("masks"))

    def run(batches):
        for batch in batches:
            for part, masks in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist()):
                table = {m["mask"]: tuple(m[w] for w in WEIGHTS) for m in masks}
                cols = list(zip(*interactions(table, names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(cols[0])), pa.array(cols[0]), pa.array(cols[1], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in cols[2:])],
                    names=["part", "filter_order", "step", *COUNTS])

    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
                           T.StructField("step", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return prepared(parts).mapInArrow(run, schema)


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(failure_counts(docs, labels), "".join(text_filters(F.lit(""))) + COPY)
