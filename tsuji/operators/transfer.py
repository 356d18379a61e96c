"""Bytes-transferred summary over HTTP log messages (A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_http_message


def parse_log(logs: DataFrame, message: str = "message") -> DataFrame:
    """Every log row with its parsed request fields (M3)."""
    p = parse_http_message(message)
    keep = [c for c in logs.columns if c != message]
    return logs.select(*keep, p["method"].alias("method"), p["status"].alias("status"),
                       p["range_header"].alias("range_header"), p["content_length"].alias("content_length"),
                       p["total_size"].alias("total_size"))


def summarize_transfer(parsed: DataFrame, by: list[str] | None = None, seq: str = "seq") -> DataFrame:
    """Per group (or over everything): n_requests, n_get, get_bytes, full_size, fraction.

    full_size is the Content-Length of the first HEAD (by ``seq``) that has one, else the largest
    Content-Range total; fraction = get_bytes / full_size, null when the size is unknown or 0.
    One partial + final aggregate: a group holding a third of all rows is pre-aggregated per task.
    """
    is_get = F.col("method") == "GET"
    head_len = F.when((F.col("method") == "HEAD") & (F.col("content_length") > 0), F.col(seq))
    aggs = [
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if(is_get).alias("n_get"),
        F.coalesce(F.sum(F.when(is_get, F.coalesce(F.col("content_length"), F.lit(0)))), F.lit(0)).cast("bigint")
        .alias("get_bytes"),
        F.coalesce(F.min_by("content_length", head_len),
                   F.max(F.when(F.col("total_size") > 0, F.col("total_size")))).alias("full_size"),
    ]
    g = parsed.groupBy(*by) if by else parsed
    out = g.agg(*aggs)
    return out.withColumn("fraction", F.when(F.col("full_size") > 0,
                                             F.col("get_bytes").cast("double") / F.col("full_size")))
