"""File sources and sinks: CSV / JSON readers with explicit schemas,
partitioned writers, JSON report bundles, table replacement.

Readers never infer schemas (inference is an extra pass over the data and
is unstable across files). Writers go to caller-given paths on shared
storage; nothing is written to a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
             columns: Sequence[str] | None = None, date_cols: Sequence[str] = (),
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with a header and an explicit schema; keep ``columns`` only
    (pruned by Catalyst); date text columns are parsed once at the scan."""
    df = spark.read.csv(list(paths) if not isinstance(paths, str) else paths, schema=schema, header=True,
                        mode="PERMISSIVE")
    if columns:
        df = df.select(*columns)
    for c in date_cols:
        df = df.withColumn(c, F.to_date(F.col(c), date_format))
    return df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def bundle(**sections: Column) -> Column:
    """One JSON document from named section columns (structs, arrays, maps,
    scalars) computed as one-row aggregates."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in sections.items()]))


def write_report(spark: SparkSession, doc: DataFrame, path: str) -> None:
    """Write a one-row report DataFrame (column ``report``) as JSON text."""
    doc.coalesce(1).write.mode("overwrite").text(path)



def require_rows(df: DataFrame, minimum: int, what: str) -> DataFrame:
    """Data-quality gate: fail the job when fewer than ``minimum`` rows."""
    n = df.count()
    if n <= minimum:
        raise ValueError(f"{what}: only {n} rows (need more than {minimum})")
    return df
