"""Structured Streaming twins of the incremental jobs.

* ``dedupe_ingest``   -- polled game rows; a repeated (game_id, team_id)
  changes nothing (watermark + dropDuplicatesWithinWatermark).
* ``latest_snapshot`` -- odds polls; latest quote per (game, day) kept as
  a streaming aggregate (max_by on the fetch time).
* ``elo_stream``      -- ratings as keyed state per league
  (applyInPandasWithState), one update per result in time order.

Sources are file streams over landed parquet, sinks are parquet files and
checkpoints live under the shared checkpoint folder, so a restarted query
resumes exactly where it stopped. ``run_available`` drives a query to the
end of its input (``availableNow``) and returns the sink as a DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.operators.rating import replay


def run_available(query_writer) -> None:
    """Run to the end of what has landed, however long that takes; a failed query raises."""
    query_writer.trigger(availableNow=True).start().awaitTermination()


def landed(spark: SparkSession, landing: str, schema) -> DataFrame:
    """A file stream over the landing folder, on a child session: the
    state-store partition count of a stateful query is the shuffle setting at
    its first start, whatever the caller sets later."""
    return spark.newSession().readStream.schema(schema).parquet(landing)


def dedupe_ingest(spark: SparkSession, landing: str, schema, out: str, checkpoint: str, delay: str,
                  keys=("game_id", "team_id"), event_time: str = "event_ts") -> None:
    """Append rows with new keys to ``out``. ``delay`` is how long after its
    event a row may come: rows later than that behind the watermark are
    dropped, and a key is remembered that long. Rows of one run that share a
    key are taken to be alike; a later run never changes what is there."""
    d = landed(spark, landing, schema).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    run_available(d.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
                  .outputMode("append"))


def latest_snapshot(spark: SparkSession, landing: str, schema, out: str, checkpoint: str) -> None:
    """Latest quote per (day, home, away). Only keys that changed leave a
    micro-batch; they are written under its number (again in place, if it is
    run again), and ``read_snapshot`` takes each key's last."""
    agg = landed(spark, landing, schema).groupBy("fetch_date", "home_team", "away_team").agg(
        F.max_by(F.struct("home_ml", "away_ml"), F.struct("fetched_at", "poll_id")).alias("_q"))
    flat = agg.select("fetch_date", "home_team", "away_team", F.col("_q.home_ml").alias("home_ml"),
                      F.col("_q.away_ml").alias("away_ml"))

    def upsert(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    run_available(flat.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint))


def read_snapshot(spark: SparkSession, out: str, keys=("fetch_date", "home_team", "away_team")) -> DataFrame:
    df = spark.read.parquet(out)
    rest = [c for c in df.columns if c not in (*keys, "epoch")]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("epoch")).alias("_r"))
    return last.select(*keys, "_r.*")


ELO_OUT = ("league int, game_id string, game_date date, home string, away string, "
           "home_pre_elo double, away_pre_elo double")
ELO_STATE = "ratings string"


def _elo_update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    ratings = json.loads(state.get[0]) if state.exists else {}
    out = replay(pd.concat(list(batches), ignore_index=True), ratings)   # updates ratings
    state.update((json.dumps(ratings),))
    yield out[["league", "game_id", "game_date", "home", "away", "home_pre_elo", "away_pre_elo"]]


def elo_stream(spark: SparkSession, landing: str, schema, out: str, checkpoint: str) -> None:
    """Periods must land in time order and be run one by one; within a run the
    replay puts a league's games in order. Each league's ratings are the keyed
    state carried between micro-batches. Sequential by definition: a league's
    games of one run are one group, so a run should land one period."""
    res = landed(spark, landing, schema).groupBy("league").applyInPandasWithState(_elo_update, ELO_OUT, ELO_STATE, "append",
                                                       GroupStateTimeout.NoTimeout)
    run_available(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
                  .outputMode("append"))
