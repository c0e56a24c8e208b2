"""Joins beyond plain equi joins: as-of, fuzzy contains, fallback chains,
bounded pair grids, alignment.

Broadcast policy: only sides whose size is fixed by the schema or checked
against a documented limit that raises are broadcast explicitly. Everything else is left to the planner, where AQE decides
at runtime from measured sizes and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_latest_before(probes: DataFrame, probe_id: Sequence[str], facts: DataFrame, key: str,
                       probe_time: str, fact_time: str, payload: Sequence[str], bucket: str = "month",
                       out: str = "asof", method: str = "bucket") -> DataFrame:
    """For each probe row (unique by ``probe_id``), the payload of the latest
    fact with the same key and ``fact_time < probe_time`` (strictly before),
    as struct ``out`` (null when there is none).

    Two levels so that a hot key is split by time: (1) probes and facts are
    unioned and scanned per (key, time bucket); (2) the latest fact of
    every earlier bucket comes from a per-(key, bucket) summary, which has
    one row per key and bucket, and is carried in with a window over that
    small table.
    """
    if method == "scan":
        return _asof_by_scan(probes, probe_id, facts, key, probe_time, fact_time, payload, out)
    unit = {"month": "month", "year": "year", "week": "week", "day": "day"}[bucket]
    pay = F.struct(F.col("_t").alias("_t"), *[F.col(c) for c in payload])
    f = facts.select(F.col(key).alias("_k"), F.col(fact_time).alias("_t"), *payload)
    f = f.withColumn("_b", F.date_trunc(unit, F.col("_t").cast("timestamp")))
    pid = F.struct(*[F.col(c) for c in probe_id])
    pk = probes.select(pid.alias("_pid"), F.col(key).alias("_k"), F.col(probe_time).alias("_t"))
    pk = pk.withColumn("_b", F.date_trunc(unit, F.col("_t").cast("timestamp")))

    pid_type = pk.schema["_pid"].dataType
    u = (f.select("_k", "_b", "_t", F.lit(1).alias("_m"), F.lit(None).cast(pid_type).alias("_pid"), pay.alias("_v"))
          .unionByName(pk.select("_k", "_b", "_t", F.lit(0).alias("_m"), "_pid",
                                 F.lit(None).cast(f.select(pay.alias("x")).schema["x"].dataType).alias("_v"))))
    # probes sort before facts of the same instant -> strictly-before semantics
    w = Window.partitionBy("_k", "_b").orderBy("_t", "_m").rowsBetween(Window.unboundedPreceding, 0)
    within = u.withColumn("_in", F.last("_v", ignorenulls=True).over(w)).filter(F.col("_m") == 0)

    summ = f.groupBy("_k", "_b").agg(F.max_by(pay, F.col("_t")).alias("_lastv"))
    wb = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # probes whose bucket has no fact still need the carry from earlier buckets
    buckets = within.select("_k", "_b").distinct()
    allb = summ.select("_k", "_b").unionByName(buckets).distinct()
    carry_all = (allb.join(summ, ["_k", "_b"], "left")
                 .withColumn("_carry", F.last("_lastv", ignorenulls=True).over(wb))
                 .select("_k", "_b", "_carry"))
    res = within.join(carry_all, ["_k", "_b"], "left") \
        .select(*[F.col(f"_pid.{c}").alias(c) for c in probe_id], F.coalesce("_in", "_carry").alias(out))
    return probes.join(res, list(probe_id), "left")


def _asof_by_scan(probes: DataFrame, probe_id: Sequence[str], facts: DataFrame, key: str, probe_time: str,
                  fact_time: str, payload: Sequence[str], out: str) -> DataFrame:
    """As-of without any per-key grouping: facts are numbered in (key, time)
    order by the prefix scan; over facts and probes in (key, time, probe
    first) order a running max of that number is the latest fact at or
    before each probe, valid when it is not below the key's first number.
    Payloads are fetched by an equi-join on the fact number."""
    from quarry.operators.ordered import global_row_number, ordered_scan
    f = facts.select(F.col(key).alias("_k"), F.col(fact_time).alias("_t"), *payload)
    f = global_row_number(f, ["_k", "_t"], "_fid")
    first = f.groupBy("_k").agg(F.min("_fid").alias("_f0"))
    pid = F.struct(*[F.col(c) for c in probe_id])
    pk = probes.select(pid.alias("_pid"), F.col(key).alias("_k"), F.col(probe_time).alias("_t"))
    u = (f.select("_k", "_t", F.lit(1).alias("_m"), "_fid", F.lit(None).cast(pk.schema["_pid"].dataType).alias("_pid"))
          .unionByName(pk.select("_k", "_t", F.lit(0).alias("_m"), F.lit(None).cast("long").alias("_fid"), "_pid")))
    sc = ordered_scan(u, ["_k", "_t", "_m", "_fid"], {"_cand": ("max", "_fid")})
    hits = sc.filter(F.col("_m") == 0).join(first, "_k", "left") \
             .withColumn("_cand", F.when(F.col("_cand") >= F.col("_f0"), F.col("_cand")))
    pay = f.select(F.col("_fid").alias("_cand"), F.struct(F.col("_t").alias("_t"), *[F.col(c) for c in payload]).alias(out))
    res = hits.join(pay, "_cand", "left").select(*[F.col(f"_pid.{c}").alias(c) for c in probe_id], out)
    return probes.join(res, list(probe_id), "left")


#: Entries a lookup list of ``fuzzy_contains_join`` may have; a longer one raises.
LOOKUP_LIMIT = 10_000


def fuzzy_contains_join(names: DataFrame, name_col: str, dim: DataFrame, code_col: str, dim_name_col: str,
                        order_col: str, out: str = "matched_code") -> DataFrame:
    """Full name -> code. Rule 1: the code or the dimension name occurs in
    the full name (case-insensitive). Rule 2: any word of the full name
    occurs in a dimension name. First hit by (rule, dimension order).

    ``dim`` is a lookup list (one row per team) of ``LOOKUP_LIMIT`` entries at
    most; a longer one raises. Substring rules have no equality to join on:
    the list becomes one array, each distinct name is tested against its
    entries in place, and no join or shuffle of pairs is planned.
    """
    n = names.select(name_col).distinct()
    d = dim.select(F.col(order_col).alias("o"), F.col(code_col).alias("c"), F.lower(F.col(dim_name_col)).alias("d")) \
           .limit(LOOKUP_LIMIT + 1).collect()
    if len(d) > LOOKUP_LIMIT:
        raise ValueError(f"the lookup list has more than {LOOKUP_LIMIT} entries")
    rows = [F.struct(F.lit(r["o"]).alias("o"), F.lit(r["c"]).alias("c"), F.lit(r["d"]).alias("d"))
            for r in sorted(d, key=lambda r: r["o"])]
    if not rows:
        return names.withColumn(out, F.lit(None).cast("string"))
    name, words = F.lower(F.col(name_col)), F.split(F.lower(F.col(name_col)), r"\s+")
    rule1 = F.filter("_dim", lambda x: name.contains(F.lower(x["c"])) | name.contains(x["d"]))
    rule2 = F.filter("_dim", lambda x: F.exists(words, lambda wd: (F.length(wd) > 0) & x["d"].contains(wd)))
    best = n.withColumn("_dim", F.array(*rows)) \
        .select(name_col, F.coalesce(F.get(rule1, 0)["c"], F.get(rule2, 0)["c"]).alias(out)).where(F.col(out).isNotNull())
    return names.join(best, name_col, "left")


def fallback_chain(df: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str, str]],
                   final: Column) -> DataFrame:
    """Left-join each (table, keys, value column, alias) and keep them as
    columns; ``final`` combines them with ``coalesce`` by the caller."""
    out = df
    for table, keys, value, alias in lookups:
        out = out.join(table.select(*keys, F.col(value).alias(alias)), list(keys), "left")
    return out.withColumn("_final", final)


def ordered_pairs(items: DataFrame, col: str, left: str = "home", right: str = "away") -> DataFrame:
    """All ordered pairs of an item list, diagonal excluded: the one operator
    whose result is a pair grid. The list may have ``LOOKUP_LIMIT`` entries; a
    longer one raises."""
    if items.limit(LOOKUP_LIMIT + 1).count() > LOOKUP_LIMIT:
        raise ValueError(f"the item list has more than {LOOKUP_LIMIT} entries")
    a = items.select(F.col(col).alias(left))
    b = items.select(F.col(col).alias(right))
    return a.join(F.broadcast(b), F.col(left) != F.col(right))


def align_to_keys(keys: DataFrame, agg: DataFrame, on: Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """Reindex an aggregate onto the full key list, missing -> ``fill``."""
    return keys.join(agg, list(on), "left").na.fill(dict(fill))
