"""File and catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Quotes are doubled inside quoted values, and no space is trimmed.
NO_VALUE = "\0"              # so that an empty quoted value is an empty text and an empty unquoted one null
CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_parquet(spark: SparkSession, path: str, partition_types: dict[str, str] | None = None) -> DataFrame:
    """Parquet file or directory, partitions discovered from ``k=v`` folders.

    Discovered partition types depend on the values (a day string comes back
    as a date, ``01`` as 1, S12), so callers name the types they wrote: those
    columns are read as the text of their folders and cast explicitly.
    """
    df = spark.read.parquet(path)
    named = {c: t for c, t in (partition_types or {}).items() if c in df.columns}
    if not named:
        return df
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in named else f.dataType) for f in df.schema.fields])
    text = spark.read.schema(schema).parquet(path)
    return text.withColumns({c: F.col(c).cast(t) for c, t in named.items()})


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with a header (A10). Types are inferred when no schema is given;
    inference reads the data once more, so production jobs pass a schema
    (or a sampling ratio below one). Quoted values may hold line ends, quotes
    and outer spaces; for that a file is read by one task, so deliver large
    data as many files."""
    reader = spark.read.option("header", header).options(**CSV_OPTIONS).option("multiLine", True).option("nullValue", NO_VALUE)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def cast_like(df: DataFrame, like: T.StructType) -> DataFrame:
    """Cast columns of ``df`` to the types of the same-named fields in ``like``."""
    types = {f.name: f.dataType for f in like.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by name."""
    return spark.table(name)


def stream_table(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """Catalog table by name as a stream (A11): rows present at the first start, then what is appended.

    Progress is in the checkpoint of the query that reads it; ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.table(name)
