"""Calendar parts, time flags and cyclical encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from faremill.functions.basics import dbl, flag
from faremill.profile import Conventions, TRAINING


def hour_start(ts: str) -> Column:
    """The full hour of a zone-less time. date_trunc would go through the session's time zone and lose or repeat hours where its clocks change."""
    t = F.col(ts).cast("timestamp_ntz")
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t), F.extract(F.lit("SECOND"), t))


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from one zone-less time to another, whatever the session's time zone."""
    gap = F.col(end).cast("timestamp_ntz") - F.col(start).cast("timestamp_ntz")
    return gap.cast("interval second").cast("bigint")


def utc_instant(ts: str) -> Column:
    """A zone-less time read as UTC, for event times of streams."""
    t = F.col(ts).cast("timestamp_ntz")
    since = (t - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((since * 1_000_000).cast("bigint"))


def zoneless(instant: Column) -> Column:
    """The UTC wall-clock time of an instant, without a zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def calendar_parts(ts: str = "tpep_pickup_datetime") -> dict[str, Column]:
    """Hour, day, month, weekday (Monday is 0), day of year and ISO week of a timestamp."""
    t = F.col(ts)
    return {
        "pickup_hour": F.hour(t),
        "pickup_day": F.day(t),
        "pickup_month": F.month(t),
        "pickup_weekday": F.weekday(t),
        "pickup_dayofyear": F.dayofyear(t),
        "pickup_weekofyear": F.weekofyear(t),
    }


def time_flags(conventions: Conventions = TRAINING, hour: str = "pickup_hour", weekday: str = "pickup_weekday") -> dict[str, Column]:
    h, d = F.col(hour), F.col(weekday)
    first, last = conventions.business_hours
    return {
        "is_weekend": flag(d >= 5),
        "is_rush_hour": flag(h.isin(*conventions.rush_hours)),
        "is_late_night": flag(h.isin(*conventions.late_hours)),
        "is_business_hours": flag(h.between(first, last) & (d < 5)),
    }


def night_and_rush_parts(hour: str = "pickup_hour") -> dict[str, Column]:
    h = F.col(hour)
    return {
        "is_night": flag(h.between(0, 6) | h.between(22, 23)),
        "is_morning_rush": flag(h.between(7, 9)),
        "is_evening_rush": flag(h.between(17, 19)),
    }


CYCLES = (("hour", "pickup_hour", 24), ("weekday", "pickup_weekday", 7), ("month", "pickup_month", 12), ("dayofyear", "pickup_dayofyear", 365))


def cyclical_encoding() -> dict[str, Column]:
    """sin and cos of each calendar part over its period."""
    out = {}
    for name, source, period in CYCLES:
        angle = dbl(source) * F.lit(2 * math.pi) / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def time_of_day(hour: str = "pickup_hour") -> Column:
    h = F.col(hour)
    return (
        F.when((h >= 6) & (h < 12), "morning")
        .when((h >= 12) & (h < 18), "afternoon")
        .when((h >= 18) & (h < 22), "evening")
        .otherwise("night")
    )


def season_of(month: str = "pickup_month") -> Column:
    m = F.col(month)
    return F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer").otherwise("Fall")


def traffic_level(hour: str = "pickup_hour", weekday: str = "pickup_weekday") -> dict[str, Column]:
    """Traffic level with its reason; the first rule that holds decides."""
    h, weekend = F.col(hour), F.col(weekday) >= 5
    rush = h.between(7, 9) | h.between(16, 19)
    rules = [
        (rush & ~weekend, "Heavy", "Weekday rush hour"),
        (weekend & h.between(12, 18), "Moderate", "Weekend midday traffic"),
        ((h >= 22) | (h <= 5), "Light", "Late night/early morning"),
    ]
    level = reason = F
    for condition, name, why in rules:
        level = level.when(condition, name)
        reason = reason.when(condition, why)
    return {"traffic_level": level.otherwise("Moderate"), "traffic_reason": reason.otherwise("Typical daytime flow")}


def rule_holiday(month: str = "pickup_month", day: str = "pickup_day", weekday: str = "pickup_weekday") -> dict[str, Column]:
    m, d, w = F.col(month), F.col(day), F.col(weekday)
    name = (
        F.when((m == 1) & (d == 1), "New Year's Day")
        .when((m == 7) & (d == 4), "Independence Day")
        .when((m == 12) & (d == 25), "Christmas Day")
        .when((m == 11) & d.between(22, 28) & (w == 3), "Thanksgiving")
        .otherwise("None")
    )
    known = flag(name != "None")
    return {"holiday_name": name, "is_holiday": known, "is_major_holiday": known, "is_holiday_week": known}
