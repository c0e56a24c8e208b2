"""Sequential team ratings (Elo).

Each result moves both teams' ratings, so within one league the games
must be replayed in time order: this is the one operator that is
sequential by definition. Leagues that never play each other are
independent, so the work is ``groupBy(league).applyInPandas`` (one task
per league, leagues in parallel). The input is the game table, whose size
is bounded by calendar days x teams, not by the raw fact tables it is
aggregated from. A streaming twin keeps the ratings as keyed state
(:mod:`quarry.streaming.jobs`).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

# Fixed values of the rating model: starting rating, update factor, scale.
ELO_BASE = 1500.0
ELO_K = 20.0
ELO_SCALE = 400.0

ELO_SCHEMA = ("league int, game_id string, game_date date, home string, away string, "
              "home_pre_elo double, away_pre_elo double, elo_diff double, exp_home double")


def expected_home(h: float, a: float) -> float:
    return 1.0 / (1.0 + 10.0 ** ((a - h) / ELO_SCALE))


def replay(pdf: pd.DataFrame, ratings: dict[str, float] | None = None, base: float = ELO_BASE,
           k: float = ELO_K) -> pd.DataFrame:
    """Replay home rows in (game_date, game_id) order from ``ratings``
    (updated in place; empty = everyone at ``base``)."""
    ratings = {} if ratings is None else ratings
    pdf = pdf.sort_values(["game_date", "game_id"], kind="mergesort")
    out = []
    for league, gid, gdate, home, away, win in pdf[["league", "game_id", "game_date", "home", "away",
                                                     "win"]].itertuples(index=False):
        h, a = ratings.get(home, base), ratings.get(away, base)
        e = expected_home(h, a)
        out.append((league, gid, gdate, home, away, h, a, h - a, e))
        ratings[home] = h + k * (float(win) - e)
        ratings[away] = a + k * ((1.0 - float(win)) - (1.0 - e))
    return pd.DataFrame(out, columns=["league", "game_id", "game_date", "home", "away", "home_pre_elo",
                                      "away_pre_elo", "elo_diff", "exp_home"])


def elo_ratings(home_games: DataFrame, league: str = "league") -> DataFrame:
    """Pre-game ratings per game. ``home_games`` has one row per game:
    league, game_id, game_date, home, away, win (home result, non-null)."""
    g = home_games.select(league, "game_id", "game_date", "home", "away", "win") \
        .withColumnRenamed(league, "league")
    return g.groupBy("league").applyInPandas(lambda p: replay(p), ELO_SCHEMA)
