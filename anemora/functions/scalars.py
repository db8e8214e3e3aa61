"""Scalar expressions: time grids, seasons, directions, heights, formats."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemora.config import Height, PowerCurve, TaxonomyBands

SEASONS = ("DJF", "MAM", "JJA", "SON")


# -- time ---------------------------------------------------------------------
def micros(ts: Column) -> Column:
    """Microseconds since the epoch (session time zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def boundary_seconds(later: Column, earlier: Column) -> Column:
    """Difference of whole epoch seconds, the way a date-part difference counts."""
    return F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))


def floor_div(value: Column, step: int) -> Column:
    """Floor division of whole numbers, exact and correct below zero."""
    return ((value - F.pmod(value, F.lit(step))) / F.lit(step)).cast("bigint")


def round_micros(us: Column, step: int, mode: str = "nearest") -> Column:
    """Snap to a grid; halves go to the even multiple."""
    rest = F.pmod(us, F.lit(step))
    base = us - rest
    if mode == "floor":
        return base
    if mode == "ceiling":
        return F.when(rest == 0, us).otherwise(base + step)
    odd = F.pmod((base / F.lit(step)).cast("bigint"), F.lit(2)) == 1
    return F.when((rest * 2 > step) | ((rest * 2 == step) & odd), base + step).otherwise(base)


def season(ts: Column) -> Column:
    month = F.month(ts)
    return (
        F.when(month.isin(12, 1, 2), "DJF").when(month.isin(3, 4, 5), "MAM")
        .when(month.isin(6, 7, 8), "JJA").when(month.isin(9, 10, 11), "SON")
    )


def season_rank(name: Column) -> Column:
    return reduce(lambda e, i: e.when(name == SEASONS[i], i), range(1, 4), F.when(name == SEASONS[0], 0)).otherwise(4)


def season_year(ts: Column) -> Column:
    """Year a season belongs to: December counts towards the next year."""
    return (F.year(ts) + F.when(F.month(ts) == 12, 1).otherwise(0)).cast("bigint")


def season_start(name: Column, year: Column) -> Column:
    """First instant of a season of a season-year."""
    first = (
        F.when(name == "DJF", F.make_date(year.cast("int") - 1, F.lit(12), F.lit(1)))
        .when(name == "MAM", F.make_date(year.cast("int"), F.lit(3), F.lit(1)))
        .when(name == "JJA", F.make_date(year.cast("int"), F.lit(6), F.lit(1)))
        .when(name == "SON", F.make_date(year.cast("int"), F.lit(9), F.lit(1)))
    )
    return first.cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.date_trunc("MONTH", ts).cast("timestamp_ntz")


def parse_instant(text: Column) -> Column:
    """ISO-8601 text, a trailing Z allowed, to a timestamp; null when it is none."""
    return F.try_to_timestamp(text)


def iso_instant(ts: Column) -> Column:
    """A UTC time as ISO-8601 text; a fraction is written, with six digits, only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.pmod(micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(fraction != 0, F.format_string(".%06d", fraction)).otherwise(""), F.lit("+00:00"))


# -- directions ---------------------------------------------------------------
def normalise_degrees(degrees: Column) -> Column:
    return F.pmod(degrees, F.lit(360.0))


def circular_difference(predicted: Column, observed: Column) -> Column:
    """Signed smallest turn in [-180, 180)."""
    return F.pmod(predicted - observed + 180.0, F.lit(360.0)) - 180.0


def sector(degrees: Column, width: float = 30.0) -> Column:
    return F.pmod(F.floor(normalise_degrees(degrees) / width), F.lit(int(360 / width))).cast("int")


# -- numbers ------------------------------------------------------------------
def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def is_close(a: Column, b: Column, rel: float = 1e-9, tolerance: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def number(text: Column) -> Column:
    """Text or number to double; empty or unreadable becomes null."""
    return F.nullif(F.trim(text.cast("string")), F.lit("")).try_cast("double")


def numeric(df: DataFrame, name: str) -> Column:
    """A column as double; text is read leniently, numbers are taken as they are."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    return number(F.col(name))


def truth(text: Column) -> Column:
    """Spellings of yes to true, everything else to false, null stays null."""
    return F.when(text.isNotNull(), F.lower(F.trim(text.cast("string"))).isin("true", "1", "yes", "on"))


def fixed(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value)


# -- height -------------------------------------------------------------------
def height_scale(height: Height) -> float:
    """Factor from source to target height."""
    if height.source_m <= 0 or height.target_m <= 0:
        raise ValueError("heights must be positive")
    if height.method == "none" or math.isclose(height.source_m, height.target_m, rel_tol=1e-9, abs_tol=1e-9):
        return 1.0
    if height.method == "log":
        rough = height.roughness_m
        if rough is None or rough <= 0 or rough >= min(height.source_m, height.target_m):
            raise ValueError("roughness length must be positive and below both heights")
        return math.log(height.target_m / rough) / math.log(height.source_m / rough)
    if height.method == "power":
        if height.alpha is None:
            raise ValueError("power law needs alpha")
        return (height.target_m / height.source_m) ** height.alpha
    raise ValueError(f"unknown height method {height.method!r}")


def height_note(height: Height) -> str | None:
    scale = height.scale
    if math.isclose(scale, 1.0, rel_tol=1e-9, abs_tol=1e-9):
        return None
    span = f"{height.source_m:.1f}→{height.target_m:.1f} m"
    if height.method == "log":
        return f"Height correction log-law {span} (scale {scale:.3f}, z0={height.roughness_m or 0.0:.4f} m)."
    return f"Height correction power-law α={height.alpha or 0.0:.3f} {span} (scale {scale:.3f})."


# -- bands and curves ---------------------------------------------------------
def coverage_band(observations: Column, bands: TaxonomyBands) -> Column:
    return (
        F.when(observations < bands.sparse_below, "sparse")
        .when(observations < bands.moderate_below, "moderate").otherwise("dense")
    )


def continuity_band(max_gap_days: Column, bands: TaxonomyBands) -> Column:
    return (
        F.when(max_gap_days.isNull(), "unknown")
        .when(max_gap_days >= bands.extreme_gap_days, "extreme_gaps")
        .when(max_gap_days >= bands.long_gap_days, "long_gaps").otherwise("regular")
    )


def curve_kw(speed: Column, curve: PowerCurve, air_density: float | None = None) -> Column:
    """Turbine output: zero below the table, linear between knots, flat above."""
    factor = 1.0 if air_density is None else air_density / curve.reference_air_density
    out = F.when(speed.isNull(), F.lit(None).cast("double")).when(speed < curve.speeds[0], F.lit(0.0))
    knots = list(zip(curve.speeds, curve.power_kw))
    for (v0, p0), (v1, p1) in zip(knots, knots[1:]):
        out = out.when(speed < v1, F.lit(p0) + (speed - v0) * ((p1 - p0) / (v1 - v0)))
    return out.otherwise(F.lit(curve.power_kw[-1])) * factor
