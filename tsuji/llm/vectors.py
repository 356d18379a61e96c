"""Vector rows in a packed form, for the two nearest-neighbour operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepared

PACKED = "id long, dim int, vec binary, norm2 double"


def packed(df: DataFrame, id_col: str, vec_col: str, scale: float | None = None, drop_zero: bool = False) -> DataFrame:
    """``id, dim, vec (doubles), norm2`` of the usable rows: a non-null id, and a vector that is not
    null and holds no null, NaN or infinite component. ``scale`` turns components into
    ``floor(scale * x)``; ``drop_zero`` leaves vectors without a non-zero component out."""
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            ids, lists = batch.column("id").to_numpy(zero_copy_only=False), batch.column("v")
            values = lists.flatten().to_numpy(zero_copy_only=False)          # null becomes NaN
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            ok = (bad[ends] == bad[ends - size]) & (size > 0)
            v = np.floor(scale * values) if scale is not None else values
            out, norm = [], []
            for i in np.flatnonzero(ok):
                x = v[ends[i] - size[i]:ends[i]]
                out.append(x.tobytes())
                norm.append(float(x @ x))
            keep = np.flatnonzero(ok)
            norm = np.array(norm)
            if drop_zero and len(keep):
                some = np.array([np.frombuffer(b).any() for b in out])
                keep, norm, out = keep[some], norm[some], [b for b, s in zip(out, some) if s]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[keep]), pa.array(size[keep].astype(np.int32)), pa.array(out, pa.binary()),
                 pa.array(norm, pa.float64())], names=["id", "dim", "vec", "norm2"])

    return prepared(rows).mapInArrow(run, PACKED)


def matrix(vecs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float64).reshape(-1, dim)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """Per query the ``k`` best of the shards' bests: highest score, then smallest id."""
    from pyspark.sql import Window

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
