"""Readers for the warehouse inputs.

``table`` reads one Parquet table of a scale-factor folder; Catalyst prunes
columns and pushes filters into the scan, so callers just ``select`` what
they need. ``read_pipe_feed`` and ``read_nested`` are the two landed-file
readers the staging layer declares (pipe-delimited change feeds, and files
with arrays of structs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_pipe_feed(spark: SparkSession, path: str, schema: T.StructType,
                   corrupt_column: str = "_corrupt_record") -> DataFrame:
    """Pipe-delimited change feed with a declared schema.

    PERMISSIVE mode keeps malformed lines: their fields are NULL and the raw
    line lands in ``corrupt_column`` so that a check can count them.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
    return (
        spark.read.schema(full)
        .option("sep", "|")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_column)
        .csv(path)
    )


def feed_counts(landed: DataFrame, op_col: str = "op", corrupt_column: str = "_corrupt_record") -> DataFrame:
    """Lines of a landed feed, malformed ones, and well-formed ones with a NULL op: one row, for a check to look at."""
    bad = F.col(corrupt_column).isNotNull()
    return landed.agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("malformed_lines"),
                      F.count_if(~bad & F.col(op_col).isNull()).alias("null_ops"))


def read_nested(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet") -> DataFrame:
    """Semi-structured feed (arrays of structs) read with its declared schema."""
    return spark.read.schema(schema).format(fmt).load(path)
