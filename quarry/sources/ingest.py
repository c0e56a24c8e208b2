"""Ingest operators: idempotent append, upsert, snapshots, skip-complete,
header normalisation, wide <-> long, nested payload flattening, HTML lists.

Upserts are set operations over DataFrames (union + one winner per key by
an ingest order), never row loops; the winner is chosen with ``max_by`` /
``min_by`` so it is a partial aggregate rather than a sort of each key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def insert_or_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is new; within the batch the first row
    per key in ``order`` wins. Returns target + new rows."""
    others = [c for c in batch.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r"))
    first = first.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
    new = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def insert_or_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Upsert: the row with the largest ``seq`` per key wins across target
    and batch (``seq`` = ingest order)."""
    u = target.unionByName(batch)
    others = [c for c in u.columns if c not in keys]
    last = u.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(seq)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def skip_complete_keys(candidates: DataFrame, existing: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Candidates whose key does not yet have ``min_rows`` rows stored."""
    done = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    return candidates.join(done.select(*keys), list(keys), "left_anti")


def normalise_headers(df: DataFrame, mapping: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """lower-case, spaces -> '_'; optional canonical names found by
    substring (first match wins); adj_close falls back to close."""
    names = [re.sub(r"\s+", "_", c.strip()).lower() for c in df.columns]
    if mapping:
        out = []
        for n in names:
            hit = next((canon for canon, subs in mapping.items() if any(s in n for s in subs)), n)
            out.append(hit)
        names = out
    d = df.toDF(*names)
    if "close" in d.columns:
        adj = F.col("adj_close") if "adj_close" in d.columns else F.lit(None).cast("double")
        d = d.withColumn("adj_close", F.coalesce(adj, F.col("close")))
    return d


def wide_to_long(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str], sep: str = "|",
                 key_names: tuple[str, str] = ("ticker", "field")) -> DataFrame:
    """Columns named '<ticker><sep><field>' -> rows (ticker, field, value)."""
    long = df.unpivot(list(id_cols), list(value_cols), "_col", "value")
    parts = F.split("_col", re.escape(sep))
    return long.select(*id_cols, parts[0].alias(key_names[0]), parts[1].alias(key_names[1]), "value")


def long_to_fields(df: DataFrame, keys: Sequence[str], field: str, value: str, fields: Sequence[str]) -> DataFrame:
    """Pivot a fixed field list back to columns (one conditional aggregate)."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(field) == f, F.col(value))).alias(f) for f in fields])


def flatten_quotes(payload: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """game -> bookmakers[] -> markets[] -> outcomes[] to one row per game
    with the first non-null moneyline per side, walking bookmakers with the
    ``preferred`` ones first (then payload order). Outcomes are matched to
    home/away by team name."""
    b = payload.select("id", "home_team", "away_team", F.posexplode_outer("bookmakers").alias("bpos", "bk"))
    m = b.select("*", F.explode_outer("bk.markets").alias("mk")).filter(F.col("mk.key") == "h2h")
    o = m.select("id", "home_team", "away_team", "bpos", F.col("bk.key").alias("book"),
                 F.explode_outer("mk.outcomes").alias("oc"))
    pref = F.array(*[F.lit(p) for p in preferred])
    pos = F.array_position(pref, F.col("book"))          # 0 when not preferred
    rank = F.when(pos == 0, F.lit(len(preferred) + 1)).otherwise(pos)
    o = o.withColumn("_ord", F.struct(rank.alias("r"), F.col("bpos").alias("p")))
    home = F.when((F.col("oc.name") == F.col("home_team")) & F.col("oc.price").isNotNull(), F.col("oc.price"))
    away = F.when((F.col("oc.name") == F.col("away_team")) & F.col("oc.price").isNotNull(), F.col("oc.price"))
    return o.groupBy("id", "home_team", "away_team").agg(
        F.min_by(home, F.when(home.isNotNull(), F.col("_ord"))).alias("home_ml"),
        F.min_by(away, F.when(away.isNotNull(), F.col("_ord"))).alias("away_ml"))


def html_list_items(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """First <ul> of each page -> one row per <li><a href=..>text</a> item
    (position, link, text), cleaned and deduplicated by text (first wins).
    Pure regular-expression extraction on the executors."""
    ul = F.regexp_extract(F.col(html_col), r"<ul>(.*?)</ul>", 1)
    item = r'<li><a href="([^"]*)">([^<]*)</a></li>'
    d = pages.select(id_col, F.regexp_extract_all(ul, F.lit(item), 1).alias("_h"),
                     F.regexp_extract_all(ul, F.lit(item), 2).alias("_t"))
    d = d.select(id_col, F.posexplode(F.arrays_zip("_h", "_t")).alias("pos", "_z"))
    d = d.select(id_col, "pos", F.trim(F.col("_z._h")).alias("href"), F.trim(F.col("_z._t")).alias("text"))
    return d.groupBy(id_col, "text").agg(F.min_by(F.struct("pos", "href"), "pos").alias("_f")) \
        .select(id_col, F.col("_f.pos").alias("pos"), F.col("_f.href").alias("href"), "text")


#: The entities that table cells hold.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": "\"", "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def _cell_text(c: Column) -> Column:
    """A cell without tags, entities read, white space made one space."""
    c = F.regexp_replace(c, "<[^>]*>", " ")
    for name, text in ENTITIES.items():  # the ampersand last, so that nothing is read twice
        c = F.replace(c, F.lit(name), F.lit(text))
    return F.trim(F.regexp_replace(c, r"[\s\u00a0]+", " "))


def html_table(pages: DataFrame, id_col: str, html_col: str, columns: Mapping[str, Sequence[str]], unique: Sequence[str] = ()) -> DataFrame:
    """First ``<table>`` of each page -> (id, row, one text column for each of
    ``columns``).

    A table is rows (``<tr>``) of cells (``<td>``, ``<th>``), tags in any case
    and with any attributes, over any number of lines. Its first row is the
    header; a column is the first header cell that holds one of its
    substrings, in any case, and null if there is none. Rows without cells and
    rows like the header are dropped; short rows end in nulls. ``unique``
    names columns of which the first row with each value stays, within the
    page. Pages without a table give no rows. A table within a cell is not
    taken apart. Everything is expressions, on the executors.
    """
    def cells(row: Column) -> Column:
        return F.transform(F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</t[dh]\b|<t[dh]\b|$)"), 1), _cell_text)

    table = F.regexp_extract(F.regexp_replace(html_col, "(?s)<!--.*?-->", ""), r"(?is)<table\b[^>]*>(.*?)</table\s*>", 1)
    rows = pages.select(F.col(id_col), F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr\b|<tr\b|$)"), 1).alias("_rows")) \
        .where(F.size("_rows") > 0)
    rows = rows.select(id_col, cells(F.col("_rows")[0]).alias("_head"), F.posexplode(F.slice("_rows", 2, 2 ** 31 - 1)).alias("row", "_row"))
    rows = rows.select(id_col, "row", "_head", cells(F.col("_row")).alias("_cells")).where((F.size("_cells") > 0) & (F.col("_cells") != F.col("_head")))
    found = {}
    for name, parts in columns.items():
        at = F.array_position(_header_hits(parts), True)  # from 1; 0 if there is none
        found[name] = F.when(at > 0, F.get("_cells", (at - 1).cast("int")))
    out = rows.select(id_col, "row", *[c.alias(n) for n, c in found.items()])
    if not unique:
        return out
    others = [c for c in out.columns if c not in (id_col, *unique)]
    first = out.groupBy(id_col, *unique).agg(F.min_by(F.struct(*others), "row").alias("_f"))
    return first.select(id_col, *unique, "_f.*").select(*out.columns)


def _header_hits(parts: Sequence[str]) -> Column:
    def hit(h: Column) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | F.contains(F.lower(h), F.lit(p.lower()))
        return out

    return F.transform("_head", hit)


#: Partitions that one batch may touch; their names pass through the driver.
MOST_TOUCHED = 10_000


def upsert_partitions(batch: DataFrame, path: str, keys: Sequence[str], seq: str, partition: str) -> int:
    """Upsert ``batch`` into the parquet table at ``path``, which is
    partitioned by ``partition``; returns the number of partitions rewritten.

    Only partitions that the batch touches are read (their names prune the
    scan) and overwritten; files of the others stay as they are. The merged
    rows are written aside first, so a run that dies can be made again: the
    same batch gives the same table. A key must keep its partition. The row
    with the largest ``seq`` of a key wins.
    """
    spark = batch.sparkSession
    touched = [r[0] for r in batch.select(partition).distinct().limit(MOST_TOUCHED + 1).collect()]
    if len(touched) > MOST_TOUCHED:
        raise ValueError(f"one batch touches more than {MOST_TOUCHED} partitions of {path}")
    try:
        spark.read.schema(batch.schema).parquet(path).limit(0).collect()
        stored = spark.read.schema(batch.schema).parquet(path).where(F.col(partition).isin(*[t for t in touched if t is not None])
                                                                     | (F.col(partition).isNull() if None in touched else F.lit(False)))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = batch.limit(0)
    merged = cut_lineage(insert_or_replace(stored, batch, keys, seq).select(*batch.columns))
    merged.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return len(touched)
