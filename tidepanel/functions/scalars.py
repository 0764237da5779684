"""Row-level column expressions. All run inside whole-stage codegen; no UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# PM2.5 segments as (upper limit, index at the start, start, slope).
PM25_SEGMENTS = (
    (30.0, 0.0, 0.0, 1.67),
    (60.0, 50.0, 30.0, 1.67),
    (90.0, 100.0, 60.0, 3.33),
    (120.0, 200.0, 90.0, 3.33),
    (250.0, 300.0, 120.0, 0.77),
    (None, 400.0, 250.0, 0.4),
)
PM25_CAP = 500.0
# Index levels as (upper limit, name).
LEVELS = (
    (50, "Good"), (100, "Satisfactory"), (200, "Moderate"),
    (300, "Poor"), (400, "Very Poor"), (None, "Severe"),
)
LEVEL_NAMES = tuple(name for _, name in LEVELS)
# Forecast quality as (MAPE below, label, colour).
QUALITY = ((15, "Excellent", "green"), (20, "Good", "blue"), (30, "Moderate", "orange"),
           (None, "Poor", "red"))
# The three season calendars in use.
SUMMER_WINTER = {4: "summer", 5: "summer", 6: "summer",
                 11: "winter", 12: "winter", 1: "winter", 2: "winter"}
FOUR_SEASONS = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
                6: "Summer", 7: "Summer", 8: "Summer", 9: "Monsoon", 10: "Monsoon",
                11: "Monsoon"}
ERROR_SEASONS = {12: "Winter (Dec-Feb)", 1: "Winter (Dec-Feb)", 2: "Winter (Dec-Feb)",
                 3: "Spring (Mar-May)", 4: "Spring (Mar-May)", 5: "Spring (Mar-May)",
                 6: "Summer/Monsoon (Jun-Sep)", 7: "Summer/Monsoon (Jun-Sep)",
                 8: "Summer/Monsoon (Jun-Sep)", 9: "Summer/Monsoon (Jun-Sep)",
                 10: "Autumn (Oct-Nov)", 11: "Autumn (Oct-Nov)"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def banded(x: Column | str, bands: Sequence[tuple], strict: bool = False) -> Column:
    """First band whose limit is not exceeded; the band without a limit takes the rest."""
    x = _col(x)
    out = None
    for limit, value in bands:
        if limit is None:
            return F.lit(value) if out is None else out.otherwise(F.lit(value))
        hit = (x < F.lit(limit)) if strict else (x <= F.lit(limit))
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def pm25_to_aqi(x: Column | str) -> Column:
    """Piecewise-linear index of a PM2.5 reading, capped at 500; NULL stays NULL."""
    x = _col(x)
    x = F.when(~F.isnan(x), x)
    out = F.when(x.isNull(), F.lit(None).cast("double"))
    for limit, base, start, slope in PM25_SEGMENTS:
        y = F.lit(base) + (x - F.lit(start)) * F.lit(slope)
        if limit is None:
            return out.otherwise(F.least(y, F.lit(PM25_CAP)))
        out = out.when(x <= F.lit(limit), y)


def aqi_bucket(x: Column | str) -> Column:
    """Level name of an index value; NULL stays NULL."""
    x = _col(x)
    return F.when(x.isNotNull(), banded(x, LEVELS))


def aqi_bucket_rank(x: Column | str) -> Column:
    """Ordinal of the level, 1 (Good) to 6 (Severe)."""
    x = _col(x)
    ranks = [(limit, i + 1) for i, (limit, _) in enumerate(LEVELS)]
    return F.when(x.isNotNull(), banded(x, ranks))


def aqi_alert(x: Column | str) -> Column:
    """'Poor' above 200, 'Moderate' above 100, otherwise NULL."""
    x = _col(x)
    return F.when(x > 200, "Poor").when(x > 100, "Moderate")


def model_quality(mape: Column | str) -> Column:
    """struct(label, color); an unknown error counts as Poor."""
    label = banded(mape, [(lim, name) for lim, name, _ in QUALITY], strict=True)
    color = banded(mape, [(lim, c) for lim, _, c in QUALITY], strict=True)
    return F.struct(label.alias("label"), color.alias("color"))


def data_quality_band(mape: Column | str) -> Column:
    return banded(mape, [(20, "High"), (30, "Medium"), (None, "Low")], strict=True)


def bar_color(mape: Column | str) -> Column:
    return banded(mape, [(20, "green"), (30, "orange"), (None, "red")], strict=True)


def trend_label(predicted: Column | str, current: Column | str) -> Column:
    """'improving' below the current level, else 'worsening'; unknown without one."""
    p, c = _col(predicted), _col(current)
    return F.when(c.isNull(), "unknown").when(p < c, "improving").otherwise("worsening")


def season(time: Column | str, calendar: Mapping[int, str]) -> Column:
    """Season name of a date; months the calendar leaves out give NULL."""
    names: dict[str, list[int]] = {}
    for m, name in calendar.items():
        names.setdefault(name, []).append(m)
    month = F.month(_col(time))
    out = None
    for name, months in names.items():
        out = (F if out is None else out).when(month.isin(months), F.lit(name))
    return out


def calendar_parts(time: Column | str, prefix: str = "") -> dict[str, Column]:
    """Hour, weekday (Monday = 0), month, quarter, year, day of year, day name."""
    t = _col(time)
    return {
        f"{prefix}hour": F.hour(t.cast("timestamp")),
        f"{prefix}day_of_week": F.weekday(t),
        f"{prefix}month": F.month(t),
        f"{prefix}quarter": F.quarter(t),
        f"{prefix}year": F.year(t),
        f"{prefix}day_of_year": F.dayofyear(t),
        f"{prefix}day_name": F.date_format(t, "EEEE"),
    }


def is_weekend(time: Column | str) -> Column:
    return (F.weekday(_col(time)) >= 5).cast("int")


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def ratio_safe(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when b is zero."""
    return _col(a) / F.nullif(_col(b), F.lit(0.0))


def clip(x: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on either side; NULL stays NULL."""
    x = _col(x)
    y = x if low is None else F.greatest(x, F.lit(float(low)))
    y = y if high is None else F.least(y, F.lit(float(high)))
    return F.when(x.isNotNull(), y)


def hours_between(start: Column | str, end: Column | str) -> Column:
    a, b = _col(start).cast("timestamp"), _col(end).cast("timestamp")
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(3_600_000_000)


def shift_days(time: Column | str, days: Column | int) -> Column:
    return F.date_add(F.to_date(_col(time)), days)


def parse_date(text: Column | str) -> Column:
    """Date of a string's first ten characters; NULL when they are no date."""
    return F.to_date(F.try_to_timestamp(F.substring(_col(text), 1, 10), F.lit("yyyy-MM-dd")))


def month_name(time: Column | str) -> Column:
    return F.date_format(_col(time), "MMM")


def horizon_to_days(hours: int | Column) -> int | Column:
    """Days a forecast horizon in hours needs, at least one."""
    if isinstance(hours, Column):
        return F.greatest(F.lit(1), F.floor(hours / 24).cast("int") + 1)
    return max(1, hours // 24 + 1)


def json_value(text: Column | str, path: str, kind: str = "string", default: object = None) -> Column:
    """A value at a JSON path, cast to ``kind``; ``default`` where the path, or the text, is not
    there or is no JSON."""
    found = F.try_variant_get(F.try_parse_json(_col(text)), path, kind)
    return found if default is None else F.coalesce(found, F.lit(default).cast(kind))
