"""Scans of the stored tables.

Tables are parquet; a scan is lazy, so column pruning and predicate
pushdown reach the parquet reader (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               where: Column | str | None = None) -> DataFrame:
    """Scan one table; ``columns`` prunes at the reader. NaN is read as null,
    behind ``where``: a filter given here is on the raw columns and reaches
    the reader, also where it is on a floating column. Later filters on other
    columns pass through and reach it too."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if where is not None:
        df = df.where(where)
    return nan_to_null(df.select(*columns) if columns else df)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Floating NaN as null, so that aggregates and joins skip it."""
    floating = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in floating.items() if columns is None or c in columns})
