"""Declared table schemas, and what breaks them.

A contract names a table's columns with type and nullability and its key.
Raw rows are read as text, so that a bad cell stays visible; one aggregate
counts what does not cast or may not be null, another the repeated keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Holds a line that could not be parsed.
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Field:
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    table: str
    fields: Mapping[str, Field]
    keys: Sequence[str] = ()

    def raw_schema(self) -> T.StructType:
        return T.StructType([*[T.StructField(c, T.StringType()) for c in self.fields], T.StructField(CORRUPT, T.StringType())])


def read_raw(spark: SparkSession, path: str, contract: Contract, fmt: str = "csv") -> DataFrame:
    """CSV (with a header) or JSON lines as text columns and ``CORRUPT``:
    lines with too few or many cells, or that are no JSON, are kept there
    instead of failing the scan or being dropped."""
    r = spark.read.schema(contract.raw_schema()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return (r.option("header", True).option("enforceSchema", False).option("columnPruning", False) if fmt == "csv" else r).format(fmt).load(path)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _present(raw: DataFrame, contract: Contract) -> list[str]:
    return [c for c in contract.fields if c in raw.columns]


def _bad(name: str, f: Field) -> Column:
    return F.col(name).isNotNull() & F.col(name).try_cast(f.type).isNull()


def violations(raw: DataFrame, contract: Contract) -> DataFrame:
    """(table_name, column_name, rule, n): a row for every column and rule,
    also where ``n`` is 0.

    Rules: ``missing`` (1 if the column is not there), ``type`` (text that is
    no value of the type), ``null`` (nulls where none may be, columns of the
    key included), and for the whole table, with the column ``*``: ``key``
    (rows more than different keys, among those whose key is whole) and
    ``record`` (lines that could not be parsed; they count nowhere else).
    """
    here = _present(raw, contract)
    read = F.col(CORRUPT).isNull() if CORRUPT in raw.columns else F.lit(True)
    needed = [c for c, f in contract.fields.items() if not f.nullable or c in contract.keys]
    counts = {("type", c): F.count_if(read & _bad(c, contract.fields[c])) for c in here}
    counts |= {("null", c): F.count_if(read & F.col(c).isNull()) for c in here if c in needed}
    if CORRUPT in raw.columns:
        counts["record", "*"] = F.count(CORRUPT)
    one = raw.agg(F.count(F.lit(1)).alias("_rows"), *[v.alias(f"{r}:{c}") for (r, c), v in counts.items()])
    line = lambda c, r, n: F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), n.cast("long").alias("n"))
    lines = [line(c, "missing", F.lit(int(c not in here))) for c in contract.fields] + [line(c, r, F.col(f"`{r}:{c}`")) for r, c in counts]
    out = one.select(F.explode(F.array(*lines)).alias("v")).select("v.*")
    if contract.keys and all(k in here for k in contract.keys):
        same = raw.where(read & F.forall(F.array(*contract.keys), lambda k: k.isNotNull()))
        keyed = same.groupBy(*contract.keys).agg(F.count(F.lit(1)).alias("_n")) \
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n"))
        out = out.unionByName(keyed.select(F.lit("*").alias("column_name"), F.lit("key").alias("rule"), "n"))
    return out.select(F.lit(contract.table).alias("table_name"), "column_name", "rule", "n")


def conforming(raw: DataFrame, contract: Contract) -> DataFrame:
    """The rows that break no rule of a cell, with the declared types. A column that is missing is null."""
    here = _present(raw, contract)
    ok = F.lit(True)
    for c, f in contract.fields.items():
        if c in here:
            ok = ok & ~_bad(c, f)
        if not f.nullable or c in contract.keys:
            ok = ok & (F.col(c).isNotNull() if c in here else F.lit(False))
    if CORRUPT in raw.columns:
        ok = ok & F.col(CORRUPT).isNull()
    return raw.where(ok).select(*[(F.col(c).try_cast(f.type) if c in here else F.lit(None).cast(f.type)).alias(c)
                                  for c, f in contract.fields.items()])
