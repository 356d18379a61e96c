"""Rows of lines for the geometry tests."""

from __future__ import annotations


def lines_df(spark, rows, extra_schema: str = "source_mesh string"):
    """DataFrame of (extra..., line) from python tuples of coordinate pairs."""
    from tsuji.functions.geom import LINE
    from pyspark.sql import types as T

    fields = [T.StructField(n.split()[0], T._parse_datatype_string(n.split()[1])) for n in extra_schema.split(",") if n.strip()]
    schema = T.StructType(fields + [T.StructField("line", LINE)])
    data = [(*r[:-1], None if r[-1] is None else [{"x": float(x), "y": float(y)} for x, y in r[-1]]) for r in rows]
    return spark.createDataFrame(data, schema)
