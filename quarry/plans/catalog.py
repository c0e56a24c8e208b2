"""Registry of named queries: Spark builder + optional DuckDB oracle SQL.

A query module registers with ``@query(name, sql=..., views=(...))``; the
oracle text is prefixed with the CTEs of the views it reads.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import views as V

VIEW_SQL = {
    "flights": V.FLIGHTS_SQL,
    "payer": V.PAYER_SQL,
    "appointments": V.APPOINTMENTS_SQL,
    "patients": V.PATIENTS_SQL,
    "marketing": V.MARKETING_SQL,
    "games": V.GAMES_SQL,
    "prices": V.PRICES_SQL,
    "sector_prices": V.SECTOR_PRICES_SQL,
    "market_prices": V.MARKET_PRICES_SQL,
    "tickers": V.TICKERS_SQL,
    "scored_events": V.SCORED_EVENTS_SQL,
    "scored_docs": V.SCORED_DOCS_SQL,
    "subscribers": V.SUBSCRIBERS_SQL,
    "shop_orders": V.SHOP_ORDERS_SQL,
    "odds": V.ODDS_SQL,
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

MODULES = ["scans", "filters", "joins", "aggregates", "windows", "topk", "scalars",
           "learning", "ml", "streams"]


def _zero_sign_safe(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: a value rounded
    to zero from below is -0.0 in IEEE arithmetic, while Spark's decimal
    rounding returns +0.0; adding 0.0 makes both +0.0."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _zero_sign_safe(sql[j + len(key):k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def with_views(views, body: str, recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs of ``views``; a body that opens with
    its own WITH (or a leading comma) continues the same CTE list."""
    ctes = [VIEW_SQL[v].strip() for v in views]
    b = body.strip()
    if not ctes:
        return b
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes)
    if b[:5].upper() == "WITH ":
        return head + ",\n" + b[5:]
    if b.startswith(","):
        return head + b
    return head + "\n" + b


def query(name: str, sql: str | None = None, views=(), recursive: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, _zero_sign_safe(with_views(views, sql, recursive)) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"quarry.plans.{m}")
    return REGISTRY
