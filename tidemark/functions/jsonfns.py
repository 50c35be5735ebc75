"""JSON shaping (X9, X11-X13): parse, extract, serialise, explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shape of a retrieval response: a ranked list of passages.
RETRIEVAL_SCHEMA = T.StructType([
    T.StructField("retrievalResults", T.ArrayType(T.StructType([
        T.StructField("content", T.StructType([T.StructField("text", T.StringType())])),
        T.StructField("score", T.DoubleType()),
    ]))),
])


def json_path(c, path: str) -> Column:
    """Extract one value as a string by JSON path, e.g. ``$.k``."""
    return F.get_json_object(_col(c), path)


def json_field(c, path: str, dtype: str) -> Column:
    """Extract a typed value by path through the variant type."""
    return F.try_variant_get(F.try_parse_json(_col(c)), path, dtype)


def to_json_struct(**fields) -> Column:
    """Serialise named columns as one JSON object per row, null fields included (X11)."""
    return F.to_json(F.struct(*[_col(v).alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def explode_results(df: DataFrame, body_col: str, schema: T.StructType = RETRIEVAL_SCHEMA,
                    list_field: str = "retrievalResults") -> DataFrame:
    """One row per element of a JSON result list, with its 1-based rank."""
    parsed = F.from_json(F.col(body_col), schema)
    return (df.select("*", F.posexplode(parsed[list_field]).alias("_pos", "_item"))
              .withColumn("rank", (F.col("_pos") + 1).cast("int"))
              .withColumn("passage", F.col("_item.content.text"))
              .drop("_pos", "_item"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
