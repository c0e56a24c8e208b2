"""Streaming queries (SURVEY section J): landed files -> Structured
Streaming -> parquet sink, compared with the batch result."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from quarry.functions.scalar import round_to
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.plans.windows import ELO_SQL
from quarry.session import scratch_path
from quarry.streaming import jobs as J


def _run_dirs(spark, sf, name):
    """Fresh landing / sink / checkpoint folders for one run."""
    base = scratch_path(spark, f"stream_{name}_{os.path.basename(sf.rstrip('/'))}_{uuid.uuid4().hex[:8]}")
    return os.path.join(base, "landing"), os.path.join(base, "out"), os.path.join(base, "checkpoint")


def _run_chunks(df, landing, chunks, job):
    """Land each chunk as it is partitioned and run the job on what is new,
    chunk by chunk: later files land later."""
    for c in chunks:
        df.filter(c).write.mode("append").parquet(landing)
        job()


@query("stream_dedupe_ingest", views=["games"], sql="""
SELECT DISTINCT game_id, team_id, pts FROM games""")
def stream_dedupe_ingest(spark, sf):
    landing, out, ck = _run_dirs(spark, sf, "dedupe")
    g = V.games(spark, sf).select("game_id", "team_id", "pts", F.col("game_date").cast("timestamp").alias("event_ts"))
    y = F.year("event_ts")
    schema = g.schema
    job = lambda: J.dedupe_ingest(spark, landing, schema, out, ck, delay="3650 days")  # noqa: E731  the log spans seven years
    _run_chunks(g, landing, [y <= 1997, (y >= 1997) & (y <= 1999), y >= 1999], job)   # overlapping polls
    # a repeated poll of already-seen keys with other values: must change nothing
    _run_chunks(g.withColumn("pts", F.col("pts") + 1000), landing, [y <= 1997], job)
    return spark.read.schema(schema).parquet(out).select("game_id", "team_id", "pts")


@query("stream_latest_snapshot", views=["odds"], sql="""
SELECT fetch_date, home_team, away_team, arg_max(home_ml, (fetched_at, poll_id)) AS home_ml,
       arg_max(away_ml, (fetched_at, poll_id)) AS away_ml
FROM odds GROUP BY fetch_date, home_team, away_team""")
def stream_latest_snapshot(spark, sf):
    landing, out, ck = _run_dirs(spark, sf, "snapshot")
    o = V.odds(spark, sf).select("poll_id", "game_key", "fetched_at", "fetch_date", "home_team", "away_team",
                                 "home_ml", "away_ml")
    d = F.dayofmonth("fetch_date")
    _run_chunks(o, landing, [d <= 10, (d > 10) & (d <= 20), d > 20],
                lambda: J.latest_snapshot(spark, landing, o.schema, out, ck))
    return J.read_snapshot(spark, out)


@query("stream_elo", views=["games"], recursive=True,
       sql=ELO_SQL.replace(",\n       round(h - a, 1) AS elo_diff FROM elo", " FROM elo"))
def stream_elo(spark, sf):
    """Streaming Elo: same pre-game ratings as the batch replay."""
    landing, out, ck = _run_dirs(spark, sf, "elo")
    g = V.games(spark, sf).filter((F.col("is_home") == 1) & F.col("win").isNotNull())
    home = g.select("league", "game_id", "game_date", F.col("team_abbr").alias("home"),
                    F.col("opponent_abbr").alias("away"), "win")
    years = [r[0] for r in home.select(F.year("game_date")).distinct().orderBy(F.year("game_date")).collect()]
    _run_chunks(home, landing, [F.year("game_date") == y for y in years],   # season by season
                lambda: J.elo_stream(spark, landing, home.schema, out, ck))
    return spark.read.parquet(out).select("game_id", "game_date", "home", "away", round_to("home_pre_elo", 1).alias("home_pre_elo"),
                      round_to("away_pre_elo", 1).alias("away_pre_elo"))
