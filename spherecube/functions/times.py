"""Time parsing, bins and resolution labels."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {"min": 60, "minute": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400}

# strptime directive -> Spark datetime pattern letters (fixed correspondence)
_DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%j": "DDD"}


def interval_seconds(text: str) -> int:
    """``30min``, ``3h``, ``1D`` ... to seconds."""
    found = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", text)
    if not found:
        raise ValueError(f"cannot read interval {text!r}; write for example '3h' or '1d'")
    unit = found.group(2).lower()
    seconds = _UNIT_SECONDS.get(unit) or _UNIT_SECONDS.get(unit.removesuffix("s"))
    if not seconds:
        raise ValueError(f"unknown interval unit {found.group(2)!r}; use min, h or d")
    if int(found.group(1)) < 1:
        raise ValueError(f"interval must be positive: {text!r}")
    return int(found.group(1)) * seconds


def spark_date_pattern(strptime_format: str) -> str:
    """Translate a strptime format into a Spark datetime pattern."""

    def swap(match: re.Match) -> str:
        token = match.group(0)
        if token not in _DIRECTIVES:
            raise ValueError(f"unsupported directive {token} in {strptime_format!r}")
        return _DIRECTIVES[token]

    literal_quoted = re.sub(r"(?<!%)[A-Za-z]+", lambda m: f"'{m.group(0)}'", strptime_format)
    return re.sub(r"%[A-Za-z]", swap, literal_quoted)


def ntz(column: Column) -> Column:
    return column.cast("timestamp_ntz")


def seconds_between(earlier: Column, later: Column) -> Column:
    """Length in seconds of the span between two zone-less times, exact to the microsecond."""
    micros = [F.unix_micros(t.cast("timestamp")) for t in (later, earlier)]
    return (micros[0] - micros[1]) / F.lit(1e6)


def bin_start(time: Column, seconds: int, start_second: int = 0) -> Column:
    """Left edge of the half-open bin ``[start, start + seconds)``; stays zone-less."""
    width = f"{seconds} seconds"
    return F.window(time, width, width, f"{start_second % seconds} seconds").getField("start")


def parse_date(text: Column, end_of_period: bool = False) -> Column:
    """Dates with day or hour precision; NULL when the text fits no accepted form.

    ``end_of_period`` moves a day to 23:59:59 and an hour to HH:59:59.
    """
    hour_form = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}$")
    day_form = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    clean = F.regexp_replace(text, "T", " ")
    hour = ntz(F.try_to_timestamp(clean, F.lit("yyyy-M-d H")))
    day = ntz(F.try_to_timestamp(text, F.lit("yyyy-M-d")))
    if end_of_period:
        hour = hour + F.expr("INTERVAL '59:59' MINUTE TO SECOND")
        day = day + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return F.when(hour_form, hour).when(day_form, day)


def parse_date_value(text: str, end_of_period: bool = False) -> dt.datetime:
    """Driver-side twin of :func:`parse_date` for a single argument; ValueError if unreadable."""
    for form, extend in (
        ("%Y-%m-%dT%H", {"minute": 59, "second": 59}),
        ("%Y-%m-%d %H", {"minute": 59, "second": 59}),
        ("%Y-%m-%d", {"hour": 23, "minute": 59, "second": 59}),
        ("%Y%m%d", {"hour": 23, "minute": 59, "second": 59}),
    ):
        try:
            value = dt.datetime.strptime(text, form)
        except ValueError:
            continue
        return value.replace(**extend) if end_of_period else value
    raise ValueError(f"cannot read date {text!r}; use YYYY-MM-DD, YYYY-MM-DDTHH or YYYYMMDD")


def from_calendar_fields(
    year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column
) -> Column:
    """Reinterpret calendar fields (Julian, noleap ...) as a proleptic Gregorian time.

    A date that does not exist there (30 February) becomes NULL.
    """
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(8,6)"))


def coarser_label(label: Column, factor: int) -> Column:
    """Resolution label after joining ``factor`` steps: 1H x 3 -> 3H, 6H x 4 -> 1D, 1D x 5 -> 5D."""
    count = F.regexp_extract(label, r"^(\d+)[HD]$", 1).try_cast("int") * factor
    hours_text = F.concat(count.cast("string"), F.lit("H"))
    days_text = F.concat(F.floor(count / 24).cast("string"), F.lit("D"))
    return (
        F.when(label.endswith("H") & (count >= 24) & (count % 24 == 0), days_text)
        .when(label.endswith("H"), hours_text)
        .when(label.endswith("D"), F.concat(count.cast("string"), F.lit("D")))
        .otherwise(label)
    )


def hours_label(target_hours: list[int]) -> str:
    """Resolution label of a resample to fixed hours of the day."""
    return f"{target_hours[1] - target_hours[0]}H"
