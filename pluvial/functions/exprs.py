"""Scalar column functions of the warehouse models (all JVM-side built-ins).

Each function takes and returns ``Column`` objects so that Catalyst keeps
them inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the warehouse's definitions
# ---------------------------------------------------------------------------
URN_PREFIX = "urn:uuid:"
# Rain category bounds in mm (evaluated in this order): NULL -> Unknown,
# = 0 -> Dry, < 2.5 -> Light rain, < 7.6 -> Moderate rain, else Heavy rain.
RAIN_LIGHT_BELOW = 2.5
RAIN_MODERATE_BELOW = 7.6
# Temperature category bounds in deg C: NULL -> Unknown, < 0 Freezing,
# < 10 Cold, < 20 Mild, else Warm.
TEMP_FREEZING_BELOW = 0
TEMP_COLD_BELOW = 10
TEMP_MILD_BELOW = 20
# Meteorological seasons (northern hemisphere) by month number.
SEASON_BY_MONTH = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Autumn", 10: "Autumn", 11: "Autumn",
}
# Day and month names are blank-padded to 9 characters ("Month"/"Day" format).
NAME_PAD = 9
# Coordinates are rounded to 4 decimals (about 11 m) to share one weather series.
COORD_PRECISION = 9
COORD_SCALE = 4

# Pain diagnosis keywords (case-insensitive LIKE patterns on condition_display).
PAIN_PATTERNS = ("%chronic%pain%", "%joint pain%", "%arthralgia%")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- S1 / S13: rounding and casts ------------------------------------------
def round_coord(col: Column | str) -> Column:
    """ROUND(x::NUMERIC, 4): half away from zero, typed decimal(9,4); NULL for a number
    that is no coordinate (100,000 or more), which the range check reports."""
    return _c(col).try_cast(f"decimal({COORD_PRECISION},{COORD_SCALE})")


def coord_key(col: Column | str) -> Column:
    """Rounded coordinate as the double a weather row is keyed by."""
    return round_coord(col).cast("double")


def round_half_up(col: Column | str, digits: int) -> Column:
    """Decimal rounding of a double (half away from zero on its decimal
    value), so 10.45 -> 10.5 although the double lies just below 10.45."""
    return F.round(_c(col).cast("decimal(24,9)"), digits).cast("double")


def utc_date(col: Column | str) -> Column:
    """``timestamp::DATE`` in UTC (session time zone is pinned to UTC)."""
    return _c(col).cast("date")


# --- S2 / S3: visit duration -------------------------------------------------
def minutes_between(start: Column | str, end: Column | str) -> Column:
    """EXTRACT(EPOCH FROM end - start) / 60; NULL if either side is NULL."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60_000_000.0)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole minutes (half away from zero), NULL unless both ends are known."""
    return F.when(_c(start).isNotNull() & _c(end).isNotNull(),
                  F.round(minutes_between(start, end)).cast("bigint"))


# --- S4 / S5: ages -------------------------------------------------------------
def age_years(on: Column | str, born: Column | str) -> Column:
    """Full years between two dates, like DATE_PART('year', AGE(on, born)).

    Counts whole months first and drops an incomplete last month, then
    truncates toward zero, so month ends, 29 February and negative spans
    behave like the calendar ``age`` function (unlike months_between/12).
    """
    on, born = _c(on), _c(born)
    months = (F.year(on) - F.year(born)) * 12 + F.month(on) - F.month(born)
    whole = F.when(on >= born, months - (F.dayofmonth(on) < F.dayofmonth(born)).cast("int")) \
        .otherwise(months + (F.dayofmonth(on) > F.dayofmonth(born)).cast("int"))
    # whole months / 12, truncated toward zero
    return (whole / F.lit(12)).cast("int")


def age_today(born: Column | str, as_of: Column | None = None) -> Column:
    """Age in full years at ``as_of`` (default CURRENT_DATE)."""
    return age_years(as_of if as_of is not None else F.current_date(), born)


# --- S6-S9: calendar attributes ---------------------------------------------
def is_weekend(day: Column | str) -> Column:
    """DOW in (0, 6) with Sunday = 0; Spark's dayofweek is 1 (Sunday)..7."""
    return F.dayofweek(_c(day)).isin(1, 7)


def padded_month_name(day: Column | str) -> Column:
    return F.rpad(F.date_format(_c(day), "MMMM"), NAME_PAD, " ")


def padded_day_name(day: Column | str) -> Column:
    return F.rpad(F.date_format(_c(day), "EEEE"), NAME_PAD, " ")


def season(month: Column | str) -> Column:
    m = _c(month)
    out = None
    for num, name in SEASON_BY_MONTH.items():
        out = F.when(m == num, name) if out is None else out.when(m == num, name)
    return out


# --- S10 / S11: weather categories ----------------------------------------------
def rain_category(prcp: Column | str) -> Column:
    p = _c(prcp)
    return (F.when(p.isNull(), "Unknown")
            .when(p == 0, "Dry")
            .when(p < RAIN_LIGHT_BELOW, "Light rain")
            .when(p < RAIN_MODERATE_BELOW, "Moderate rain")
            .otherwise("Heavy rain"))


def temp_category(tavg: Column | str) -> Column:
    t = _c(tavg)
    return (F.when(t.isNull(), "Unknown")
            .when(t < TEMP_FREEZING_BELOW, "Freezing")
            .when(t < TEMP_COLD_BELOW, "Cold")
            .when(t < TEMP_MILD_BELOW, "Mild")
            .otherwise("Warm"))


# --- D6 / D7: analysis flags --------------------------------------------------
def is_pain_diagnosis(display: Column | str, patterns: Sequence[str] = PAIN_PATTERNS) -> Column:
    d = _c(display)
    out = None
    for pat in patterns:
        cond = d.ilike(pat)
        out = cond if out is None else (out | cond)
    return out


def is_rainy(prcp: Column | str) -> Column:
    """Three-valued: NULL when precipitation is unknown."""
    p = _c(prcp)
    return F.when(p.isNotNull(), p > 0)


# --- A8-A10, S16-S19: source-edge helpers ---------------------------------------
def strip_urn(ref: Column | str) -> Column:
    """NULL for NULL or empty references, else every 'urn:uuid:' removed."""
    return F.replace(F.nullif(_c(ref), F.lit("")), F.lit(URN_PREFIX), F.lit(""))


def first_of(arr: Column | str) -> Column:
    """First element, NULL when the array is NULL or empty (ANSI-safe)."""
    return F.get(_c(arr), 0)


def codeable_first(concept: Column | str, field: str) -> Column:
    """``concept.coding[0].field`` with NULL when any step is missing."""
    return first_of(_c(concept).getField("coding")).getField(field)


def last_url_segment(url: Column | str) -> Column:
    return F.element_at(F.split(F.rtrim(_c(url), F.lit("/")), "/"), -1)


def code_from_url(url: Column | str) -> Column:
    """Last URL segment, NULL when it has no letter (a release year, say)."""
    seg = last_url_segment(url)
    return F.when(seg.rlike("[A-Za-z]"), seg)


def nan_to_null(col: Column | str) -> Column:
    c = _c(col)
    return F.when(~F.isnan(c), c)
