"""Mixing sources to target weights by weighted fair queueing.

Every document waits in its source's queue, in a shuffled but repeatable order. A copy's virtual
finish time is the source's cumulative tokens up to and including it, divided by the source's
target; serving all queues in order of finish time keeps them at their target ratio at every
moment. The mix is the prefix of that global order that fits the total budget.

Rows of the same source, id and text wait in one place: they are one entry with a number of rows, formed
before any shuffle, and are served one after the other. So a pass may end inside an entry; it then takes
the first few of its rows.

Defined cases: a null or empty text has size 0 and is taken 0 words; a null source is a source of
its own, ordered last; repeated ids with different texts queue separately; rows repeated in full are served
in turn and differ by at most one pass in how often they are taken, except where all passes end in them; an empty
table gives an empty result; columns named like the working ones do not matter, since only the named inputs
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)      # by rank of the source, repeating
BUDGET = 1.5                   # all targets together, as a multiple of all sizes
MAX_PASSES = 2                 # a document may be taken this often
SEED = 17
QUEUE_ROWS = 4096              # rows of a piece of a queue that is summed in one task
BLOCK_ROWS = 4096              # rows of an entry that one task writes out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def queue_key(source: Column) -> Column:
    """Sorts by source in code-point order with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def place_of(seed: int, row_id: Column, text: Column) -> Column:
    """The repeatable shuffle order: a uniform number from 0 to 2^63."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), row_id, text), 1)


def source_targets(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
                   passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: ``queue, source_size, target``. Budgets are shared by weight; a target
    stops at ``passes`` times the source's size and the excess is shared again by weight among the
    rest. Sorted by size per weight, the capped sources are a prefix, so the final share level is
    found with two running sums over the per-source table instead of repeated rounds."""
    per = sized.groupBy("queue").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    by_name, everything = Window.orderBy("queue"), Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("weight", weight)
           .withColumn("cap", F.lit(float(passes)) * F.col("source_size"))
           .withColumn("total", F.lit(budget) * F.sum("source_size").over(everything)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "queue")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    per = per.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    # the share level of the first source that is not capped holds for all that follow it
    final = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "queue", "level"))).over(everything)
    return per.withColumn("final", final).select(
        "queue", "source_size",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.col("final.level") * F.col("weight")).alias("target"))


def queued(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           seed: int = SEED) -> DataFrame:
    """``queue, place, id, size, rows``: what the mix needs of the documents, written once. ``queue`` is
    the source's key, ``place`` the shuffle order, ``rows`` how many rows are the same."""
    rows = docs.select(
        queue_key(F.col(source_col)).alias("queue"), place_of(seed, F.col(id_col), F.col(text_col)).alias("place"),
        F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"))
    return written(rows.groupBy("queue", "place", "id", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-queue")


def numbered(entries: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of every entry, with its ``number`` from 1. The rows of a large entry are
    written out by many tasks."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {block_rows}"))).alias("block")
    large = entries.where(F.col("rows") > block_rows).select("*", block).repartition("queue", "place", "block")
    first = F.col("block") * block_rows
    last = F.least(F.col("rows"), first + block_rows)
    return (entries.where(F.col("rows") <= block_rows).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("number"))
            .unionByName(large.select("*", F.explode(F.sequence(first + 1, last)).alias("number")).drop("block")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, budget: float = BUDGET, passes: int = MAX_PASSES, seed: int = SEED,
        queue_rows: int = QUEUE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``queue, place, id, size, rows, source_size, target, taken_0, taken_1, ...`` per entry: ``taken_k`` is
    how many of its rows pass ``k`` takes.

    A queue is cut into pieces by its (uniform) shuffle hash, so a source that holds a third of all
    rows is summed by many tasks: sums per (queue, piece), a running sum over those few rows, and a
    running sum inside each piece. The serving order is one range sort of (finish time) rows without
    text; only the range partition in which the budget ends is summed row by row."""
    entries = queued(docs, id_col, text_col, source_col, seed)
    n, all_words, n_rows = entries.agg(F.count(F.lit(1)), F.sum(F.col("size") * F.col("rows")), F.sum("rows")).first()
    n_pieces = max(1, -(-n // queue_rows))
    entries = entries.withColumn("piece", F.shiftright(F.shiftright("place", 32) * F.lit(n_pieces), 31))   # ordered like place
    targets = source_targets(entries, weights, budget, passes)

    words = F.col("size") * F.col("rows")
    sums = entries.groupBy("queue", "piece").agg(F.sum(words).alias("piece_size"))
    w_queue = Window.partitionBy("queue").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sums.withColumn("start", F.coalesce(F.sum("piece_size").over(w_queue), F.lit(0)))
              .drop("piece_size").join(targets, "queue"))
    w_piece = (Window.partitionBy("queue", "piece").orderBy("place", "id", "size")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    served = (entries.join(starts, ["queue", "piece"])
              .withColumn("before", F.col("start") + F.sum(words).over(w_piece) - words)
              .select("queue", "place", "id", "size", "rows", "source_size", "target", "before"))
    served = written(served, "mix-served")

    def finish(k: int, number: Column) -> Column:
        return (F.col("before") + number * F.col("size") + F.lit(k) * F.col("source_size")) / F.col("target")

    served_copies = F.array(*[F.struct(finish(k, F.col("number")).alias("finish"), F.lit(k).alias("copy")) for k in range(passes)])
    copies = numbered(served.where("size > 0 and target > 0"), block_rows).select(
        F.explode(served_copies).alias("c"), "queue", "place", "id", "size").select("c.*", "queue", "place", "id", "size")
    order = ["finish", "copy", "queue", "place", "id", "size"]
    # an explicit number of ranges, from the row count: the ranges are numbered and re-read below
    n_rows = n_rows or 0
    ranges = max(1, passes * n_rows // 100_000, min(32, passes * n_rows // 1000))
    sorted_copies = written(copies.repartitionByRange(ranges, *order)
                            .withColumn("part", F.spark_partition_id()), "mix-order")
    limit = budget * (all_words or 0)
    w_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = (sorted_copies.groupBy("part").agg(F.sum("size").alias("s"))
            .withColumn("start", F.coalesce(F.sum("s").over(w_parts), F.lit(0)))
            .where((F.col("start") <= limit) & (F.col("start") + F.col("s") > limit)).first())
    if last is None:                      # everything fits
        cut = None
    else:                                 # the one range in which the budget ends
        inside = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cut = (sorted_copies.where(F.col("part") == last["part"])
               .withColumn("upto", F.lit(last["start"]) + F.sum("size").over(inside))
               .where(F.col("upto") > limit).orderBy(*order).first())
    kinds = dict(zip(order, ("double", "int", "string", "long", dict(served.dtypes)["id"], "long")))

    def taken(k: int) -> Column:
        """Rows of an entry that are served before the cut: nearly the quotient, and exactly the last
        number whose finish time comes first."""
        if cut is None:
            return F.col("rows")
        end = F.struct(*[F.lit(cut[c]).cast(kinds[c]).alias(c) for c in order])

        def fits(number: Column) -> Column:
            return F.struct(finish(k, number).alias("finish"), F.lit(k).alias("copy"), "queue", "place", "id", "size") < end

        near = F.floor((F.lit(cut["finish"]) * F.col("target") - F.col("before") - F.lit(k) * F.col("source_size")) / F.col("size"))
        number = F.lit(0).cast("long")
        for step in (-1, 0, 1):
            at = near + step
            number = F.when(fits(at), at).otherwise(number)
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("rows"), number))

    able = (F.col("size") > 0) & (F.col("target") > 0)
    return served.select("queue", "place", "id", "size", "rows", "source_size", F.col("target").cast("double").alias("target"), *[
        F.when(able, taken(k)).otherwise(F.lit(0).cast("long")).alias(f"taken_{k}") for k in range(passes)])


def mix_report(docs: DataFrame, passes: int = MAX_PASSES, **kw) -> DataFrame:
    """Every row with the words the mix takes of it."""
    times = sum((F.when(F.col("number") <= F.col(f"taken_{k}"), 1).otherwise(0) for k in range(passes)), F.lit(0))
    return numbered(mix(docs, passes=passes, **kw), kw.get("block_rows", BLOCK_ROWS)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = SEED, passes: int = MAX_PASSES, **kw) -> DataFrame:
    """The mix itself: every document as often as it is taken (0 to ``passes`` times).

    Within a queue each pass takes a prefix of the shuffle order, so a row needs only its queue's few
    last places, and texts are not shuffled. The entry a pass ends in, if it has several rows, is counted
    before it is shuffled, and the rows taken are written out again from the counts."""
    entries = mix(docs, id_col, text_col, source_col, seed=seed, passes=passes, **kw)
    part = F.lit(False)
    for k in range(passes):
        part = part | ((F.col(f"taken_{k}") > 0) & (F.col(f"taken_{k}") < F.col("rows")))
    ends = written(entries.groupBy(F.col("queue").alias("_mix_queue")).agg(
        *[F.max(F.when(F.col(f"taken_{k}") == F.col("rows"), F.col("place"))).alias(f"last_{k}") for k in range(passes)],
        F.collect_list(F.when(part, F.struct("place", F.array(*[f"taken_{k}" for k in range(passes)]).alias("taken")))).alias("ends")),
        "mix-ends")                                              # a pass ends in one entry: at most one a pass
    keyed = docs.select(F.struct("*").alias("_mix_row"), queue_key(F.col(source_col)).alias("_mix_queue"),
                        place_of(seed, F.col(id_col), F.col(text_col)).alias("_mix_place"))
    keyed = keyed.withColumn("_mix_words", F.coalesce(F.col("_mix_row")[text_col].rlike(WORD), F.lit(False))).where("_mix_words")
    keyed = keyed.join(ends, "_mix_queue").withColumn("_mix_end", F.get(F.filter("ends", lambda e: e["place"] == F.col("_mix_place")), 0))
    fits = [F.col("_mix_place") <= F.col(f"last_{k}") for k in range(passes)]
    times = sum((F.when(f, 1).otherwise(0) for f in fits), F.lit(0))
    plain = keyed.where("_mix_end is null").withColumn("_mix_n", times.cast("long"))
    # rows of an entry a pass ends in: equal rows are numbered by their counts
    equal = keyed.where("_mix_end is not null").groupBy("_mix_queue", "_mix_place", "_mix_end", "_mix_row").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_mix_queue", "_mix_place").orderBy(F.sha2(F.to_json("_mix_row"), 256))
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mine = F.aggregate("_mix_end.taken", F.lit(0).cast("long"), lambda a, c: a + F.greatest(
        F.lit(0).cast("long"), F.least(c, F.col("_mix_upto")) - (F.col("_mix_upto") - F.col("n"))))
    split = equal.withColumn("_mix_upto", upto).withColumn("_mix_n", mine)
    chosen = plain.select("_mix_row", "_mix_n").unionByName(split.select("_mix_row", "_mix_n")).where("_mix_n > 0")
    return (chosen.select("_mix_row", F.explode(F.sequence(F.lit(1).cast("long"), "_mix_n")))
            .select(*[F.col("_mix_row")[c].alias(c) for c in docs.columns]))
