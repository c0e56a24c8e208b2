"""Scalar column helpers (string, date, math, odds, bins, flags).

All return ``Column`` expressions built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen. ANSI mode is assumed on, hence
``try_divide`` wherever a denominator can be zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- safe arithmetic -------------------------------------------------------

def safe_divide(num, den, zero_as=None) -> Column:
    """num / den with den = 0 or null -> ``zero_as`` (null by default)."""
    q = F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))
    return q if zero_as is None else F.coalesce(q, F.lit(zero_as))



def clip(x, lower=None, upper=None) -> Column:
    """Two-sided clip; null stays null (least/greatest would skip it)."""
    e = _c(x)
    out = e
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(e.isNull(), F.lit(None)).otherwise(out)


def nan_guard(x, default=0.0) -> Column:
    """null or NaN -> default."""
    return F.coalesce(F.nanvl(_c(x), F.lit(None).cast("double")), F.lit(default))


def lenient_double(x, default=None) -> Column:
    """Parse a number; bad text -> null (or ``default``)."""
    v = F.expr(f"try_cast({_sql(x)} AS DOUBLE)") if isinstance(x, str) else x.try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default))


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_string(x, upper: bool = False) -> Column:
    e = F.trim(_c(x).cast("string"))
    return F.upper(e) if upper else e


# --- flags, tiers, bins ----------------------------------------------------

def flag(cond: Column, null_as: int = 0) -> Column:
    """Boolean -> 0/1 int; null decided explicitly (pandas compares NaN as false)."""
    return F.coalesce(cond.cast("int"), F.lit(null_as))


def tiers(x, cuts: Sequence[tuple[float, str]], default: str, descending: bool = True) -> Column:
    """Value -> label. ``cuts`` are (threshold, label) checked in order
    with ``x >= t`` (descending) or ``x <= t`` (ascending)."""
    e = _c(x)
    out = None
    for t, label in cuts:
        cond = e >= F.lit(t) if descending else e <= F.lit(t)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def bin_cut(x, edges: Sequence[float]) -> Column:
    """Right-closed bins (e0,e1] -> 0, (e1,e2] -> 1, ...; outside -> null."""
    e = _c(x)
    out = None
    for i in range(len(edges) - 1):
        cond = (e > F.lit(edges[i])) & (e <= F.lit(edges[i + 1]))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def bin_floor(x, width: float, max_bin: int) -> Column:
    """min(floor(x / width), max_bin): left-closed bins."""
    return F.least(F.floor(_c(x) / F.lit(width)).cast("int"), F.lit(max_bin))


def map_with_default(x, mapping: Mapping, default=None, keep_self: bool = False) -> Column:
    """Dictionary lookup through a literal map; unknown -> default (or itself)."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    looked = F.try_element_at(m, _c(x))
    fallback = _c(x) if keep_self else F.lit(default)
    return F.coalesce(looked, fallback)


# --- odds ------------------------------------------------------------------

def odds_to_probability(odds) -> Column:
    """American odds -> implied probability; null stays null."""
    o = _c(odds)
    return (F.when(o > 0, F.lit(100.0) / (o + F.lit(100.0)))
             .when(o < 0, F.abs(o) / (F.abs(o) + F.lit(100.0))))


def profit_per_unit(odds) -> Column:
    """Profit per 100 staked at American odds."""
    o = _c(odds)
    return F.when(o > 0, o).otherwise(F.lit(100.0) * F.lit(100.0) / F.abs(o))


def breakeven_probability(odds) -> Column:
    o = _c(odds)
    return F.lit(100.0) / (profit_per_unit(o) + F.lit(100.0))


# --- dates -----------------------------------------------------------------

def month_label(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def quarter_label(d) -> Column:
    e = _c(d)
    return F.concat(F.year(e).cast("string"), F.lit("Q"), F.quarter(e).cast("string"))


def weekday_mon0(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def date_from_month_text(m) -> Column:
    return F.to_date(F.concat(_c(m), F.lit("-01")))


def parse_date_multi(x, formats: Sequence[str] = ("MMM dd, yyyy", "yyyy-MM-dd", "MM/dd/yyyy")) -> Column:
    """First format that parses wins; none -> null."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(_c(x), F.lit(f))) for f in formats])


def hhmm_hour(x) -> Column:
    return (_c(x) / F.lit(100)).cast("int")


# --- strings ---------------------------------------------------------------

def contains_ci(x, needle: str) -> Column:
    """Case-insensitive contains with null -> false."""
    return F.coalesce(F.lower(_c(x)).contains(needle.lower()), F.lit(False))



def parse_matchup(matchup, own) -> tuple[Column, Column]:
    """'AAA vs. BBB' (home) / 'AAA @ BBB' (away) -> (is_home, opponent)."""
    m = _c(matchup)
    is_home = F.coalesce(m.contains("vs."), F.lit(False)).cast("int")
    parts = F.split(m, r"\s+(vs\.|@)\s+")
    others = F.filter(parts, lambda p: F.trim(p) != _c(own))
    opp = F.coalesce(F.trim(F.element_at(others, 1)), F.lit("UNK"))
    opp = F.when(F.size(parts) >= 2, opp).otherwise(F.lit("UNK"))
    return is_home, opp


def strip_prefixes(x, prefixes: Sequence[str]) -> Column:
    pat = "^(" + "|".join(p.replace(".", r"\.") for p in prefixes) + ")"
    return F.regexp_replace(_c(x), pat, "")


def round_to(x, digits: int) -> Column:
    """round(x * 10^d) / 10^d: scale first, then round half away from zero.

    Rounding the scaled double (rather than its decimal text) gives the
    same result as SQL engines that implement round(x, d) that way, so
    report values agree bit-for-bit with the oracle.
    """
    m = float(10 ** digits)
    return F.round(_c(x) * F.lit(m)) / F.lit(m)
