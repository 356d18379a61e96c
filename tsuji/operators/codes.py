"""Code tables and the decode join.

The code tables are tiny fixed dimensions (at most 7 rows each), so joining them with
``broadcast`` is safe at any fact-table size: the broadcast side has a proven size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The five road code tables (code -> label), in code order.
CODE_TABLES: dict[str, list[tuple[int, str]]] = {
    "road_type": [(1, "通常部"), (2, "庭園路"), (3, "徒歩道"), (4, "石段"), (5, "不明")],
    "road_classification": [(1, "国道"), (2, "都道府県道"), (3, "市区町村道等"), (4, "高速自動車国道等"),
                            (5, "その他"), (6, "不明")],
    "road_status": [(1, "通常部"), (2, "橋・高架"), (3, "トンネル"), (4, "雪囲い"), (5, "建設中"),
                    (6, "その他"), (7, "不明")],
    "width_category": [(1, "3m未満"), (2, "3m-5.5m未満"), (3, "5.5m-13m未満"), (4, "13m-19.5m未満"),
                       (5, "19.5m以上"), (6, "不明")],
    "toll_category": [(1, "有料"), (2, "無料")],
}

CODE_SCHEMA = T.StructType([T.StructField("code", T.ShortType(), False),
                            T.StructField("label", T.StringType(), False)])

# Source attribute -> normalised column name (fixed values of the delivery format).
COLUMN_MAP = {
    "N13_001": "registration_date",
    "N13_002": "road_type",
    "N13_003": "road_classification",
    "N13_004": "road_status",
    "N13_005": "layer_order",
    "N13_006": "width_category",
    "N13_007": "toll_category",
    "N13_008": "secondary_mesh_code",
}
CODE_COLUMNS = ("road_type", "road_classification", "road_status", "width_category", "toll_category")


def code_table(spark: SparkSession, name: str) -> DataFrame:
    """Inline rows (S7) for one code table."""
    return spark.createDataFrame(CODE_TABLES[name], CODE_SCHEMA)


def code_table_sql(name: str) -> str:
    """The same table as a portable ``VALUES`` list (used by oracles)."""
    rows = ", ".join(f"({c}, '{lbl}')" for c, lbl in CODE_TABLES[name])
    return f"(SELECT CAST(code AS SMALLINT) AS code, label FROM (VALUES {rows}) AS t(code, label))"


def decode(df: DataFrame, spark: SparkSession, column: str, label_alias: str | None = None,
           keep_code: bool = False) -> DataFrame:
    """Inner equi join to the code table of ``column`` (unmatched codes drop, as in SQL)."""
    dim = code_table(spark, column).withColumnRenamed("code", "_code").withColumnRenamed(
        "label", label_alias or f"{column}_label")
    out = df.join(F.broadcast(dim), df[column] == dim["_code"], "inner").drop("_code")
    return out if keep_code else out.drop(column)
