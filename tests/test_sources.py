"""Sources: HTML tables, upserts by partition, contracts, NaN at scans."""

import math
import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import contracts as CT
from quarry.sources import ingest as ING
from quarry.sources.tables import read_table

HTML = """<html><table class="other"><caption>x</caption>
<TR><TH>Ticker symbol</TH><th scope=col>Company <b>name</b></th><th>GICS&nbsp;Sector</th><th>Added</th></tr>
<tr><td><a href="/a">AAA</a></td><td>A &amp; Sons</td><td>Tech</td><td>1999</td></tr>
<tr><td>BBB<!-- <td>no</td> --></td><td>B&lt;C</td><td>Energy
 and more</td></tr>
<tr><td>AAA</td><td>Second A</td><td>Tech</td><td>2001</td></tr>
<tr></tr>
<tr><th>Ticker symbol</th><th>Company name</th><th>GICS Sector</th><th>Added</th></tr>
<tr><td>CCC<td>no closing tags<td>Tech
</table><table><tr><td>later</td></tr></table></html>"""


def test_html_table_finds_columns_by_header(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<p>none</p>"), (3, None), (4, ""), (5, "<table><tr><td>Symbol</td></tr><tr><td>Z</td></tr></table>"),
                                   (6, "<table></table>"), (7, "<table><tr><td>ticker</td></tr>" + "<tr><td>x</td></tr>" * 5000 + "</table>")],
                                  "page_id long, html string")
    columns = {"ticker": ["symbol", "ticker"], "name": ["company", "security"], "sector": ["sector"], "added": ["date added", "added"], "cik": ["cik"]}
    got = ING.html_table(pages, "page_id", "html", columns, unique=["ticker"])
    rows = {(r["page_id"], r["ticker"]): r for r in got.collect()}
    assert set(rows) == {(1, "AAA"), (1, "BBB"), (1, "CCC"), (5, "Z"), (7, "x")}
    a, b, c = (rows[1, t] for t in ("AAA", "BBB", "CCC"))
    assert (a["name"], a["sector"], a["added"], a["cik"]) == ("A & Sons", "Tech", "1999", None)
    assert (b["name"], b["sector"], b["added"]) == ("B<C", "Energy and more", None)
    assert (c["name"], c["sector"]) == ("no closing tags", "Tech")
    assert ING.html_table(pages, "page_id", "html", columns).where("page_id = 1 and ticker = 'AAA'").count() == 2
    assert ING.html_table(pages.where("page_id = 7"), "page_id", "html", columns).count() == 5000


def files(path):
    return {d: sorted((f, os.path.getmtime(os.path.join(path, d, f))) for f in os.listdir(os.path.join(path, d)) if f.startswith("part-"))
            for d in os.listdir(path) if d.startswith("month=")}


def test_upsert_rewrites_touched_months_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "id long, v string, seq int, month string")
    assert ING.upsert_partitions(make([(k, "old", 1, f"2024-0{1 + k % 3}") for k in range(30)]), path, ["id", "month"], "seq", "month") == 3
    before = files(path)
    batch = make([(0, "new", 2, "2024-01"), (100, "added", 2, "2024-01"), (3, "late", 0, "2024-01"), (7, "fresh", 2, "2024-09"), (8, "x", 2, None)])
    assert ING.upsert_partitions(batch, path, ["id", "month"], "seq", "month") == 3
    after = files(path)
    assert {d for d in before if before[d] == after[d]} == {"month=2024-02", "month=2024-03"}
    assert set(after) - set(before) == {"month=2024-09", "month=__HIVE_DEFAULT_PARTITION__"}
    got = {(r["id"], r["month"]): r["v"] for r in spark.read.schema(batch.schema).parquet(path).collect()}
    assert len(got) == 33 and got[0, "2024-01"] == "new" and got[3, "2024-01"] == "old" and got[100, "2024-01"] == "added" and got[8, None] == "x"
    assert ING.upsert_partitions(batch, path, ["id", "month"], "seq", "month") == 3  # again: the same table
    assert {(r["id"], r["month"]): r["v"] for r in spark.read.schema(batch.schema).parquet(path).collect()} == got
    assert ING.upsert_partitions(batch.limit(0), path, ["id", "month"], "seq", "month") == 0
    assert spark.read.schema(batch.schema).parquet(path).count() == 33


CONTRACT = CT.Contract("t", {"a": CT.Field("long", False), "b": CT.Field("double"), "d": CT.Field("date"), "gone": CT.Field("string")}, ["a", "d"])


def test_violations_and_conforming_rows(spark):
    raw = spark.createDataFrame([("1", "2.5", "2024-01-01"), ("1", "x", "2024-01-01"), ("1", None, "2024-01-01"), (None, "1", "2024-02-30"), ("z", "1", None)],
                                "a string, b string, d string")
    got = {(r["column_name"], r["rule"]): r["n"] for r in CT.violations(raw, CONTRACT).collect()}
    assert got == {("a", "missing"): 0, ("b", "missing"): 0, ("d", "missing"): 0, ("gone", "missing"): 1, ("a", "type"): 1, ("b", "type"): 1,
                   ("d", "type"): 1, ("a", "null"): 1, ("d", "null"): 1, ("*", "key"): 2}
    ok = CT.conforming(raw, CONTRACT)
    assert sorted(map(str, ok.collect())) == sorted(map(str, ok.collect())) and ok.count() == 2
    assert dict(ok.dtypes) == {"a": "bigint", "b": "double", "d": "date", "gone": "string"}
    none = {(r["column_name"], r["rule"]): r["n"] for r in CT.violations(raw.limit(0), CONTRACT).collect()}
    assert set(none) == set(got) and none["*", "key"] == 0


def test_corrupt_lines_are_kept(spark, tmp_path):
    c = CT.Contract("t", {"a": CT.Field("long"), "b": CT.Field("string")}, ["a"])
    (tmp_path / "x.csv").write_text("a,b\n1,u\n2,v,too many\n3\nq,w\n")
    raw = CT.read_raw(spark, str(tmp_path / "x.csv"), c)
    got = {(r["column_name"], r["rule"]): r["n"] for r in CT.violations(raw, c).collect()}
    assert got["*", "record"] == 2 and got["a", "type"] == 1
    assert [tuple(r) for r in CT.conforming(raw, c).collect()] == [(1, "u")]
    (tmp_path / "x.json").write_text('{"a": 1, "b": "u"}\n{"a": \n{"b": "w"}\n')
    raw = CT.read_raw(spark, str(tmp_path / "x.json"), c, "json")
    got = {(r["column_name"], r["rule"]): r["n"] for r in CT.violations(raw, c).collect()}
    assert got["*", "record"] == 1 and got["a", "null"] == 1


def test_nan_changes_no_average_and_filters_push_down(spark, tmp_path):
    rows = [(k, float(k), float(k)) for k in range(10)] + [(10, float("nan"), float("nan")), (11, None, None)]
    spark.createDataFrame(rows, "k long, x double, y double").withColumn("y", F.col("y").cast("float")).write.parquet(str(tmp_path / "t.parquet"))
    d = read_table(spark, str(tmp_path), "t", ["k", "x", "y"])
    r = d.agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("x").alias("n"), F.max("x").alias("m")).first()
    assert (r["x"], r["y"], r["n"], r["m"]) == (4.5, 4.5, 10, 9.0) and not any(math.isnan(v["x"]) for v in d.where("x is not null").collect())
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,3.0)" in plan(read_table(spark, str(tmp_path), "t", ["k", "x"], where=F.col("x") > 3.0))
    p = plan(read_table(spark, str(tmp_path), "t", ["k", "x", "y"]).where("k = 5").select("x"))
    assert "EqualTo(k,5)" in p and "ReadSchema: struct<k:bigint,x:double>" in p
    assert dict(d.dtypes)["y"] == "float"


@pytest.mark.parametrize("html", ["<table><tr><td>a", "<tr><td>a</td></tr>", "<table><tr></tr></table>"])
def test_broken_tables_give_no_rows(spark, html):
    assert ING.html_table(spark.createDataFrame([(1, html)], "page_id long, html string"), "page_id", "html", {"a": ["a"]}).count() == 0
