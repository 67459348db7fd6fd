"""File, store and variable names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.functions.times import ntz, spark_date_pattern

# Fixed name layouts of stores: with and without a time-resolution part.
STORE_NAME = r"^(.+)_([0-9]+[HD])_zoom(\d+)_(\d{8})_(\d{8})"
STORE_NAME_NO_RES = r"^(.+)_zoom(\d+)_(\d{8})_(\d{8})"
# Fixed pattern of the two dates in a file that covers a span of days.
SPAN_DATES = r"\.(\d{8})\d{2}_(\d{8})\d{2}\.nc"
# Cell-boundary variables are never data.
BOUNDS_SUFFIX = r"(_bnds|_bounds)$"


def checked_regex(pattern: str) -> str:
    try:
        groups = re.compile(pattern).groups
    except re.error as exc:
        raise ValueError(f"bad date pattern {pattern!r}: {exc}") from exc
    if groups < 1:
        raise ValueError(f"date pattern {pattern!r} needs a group around the date")
    return pattern


def glob_to_regex(glob: str) -> str:
    """Shell wildcard to an anchored regular expression (``*``, ``?``, ``[...]``)."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        close = glob.find("]", i + 2) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return "^" + "".join(out) + "$"


def date_in_name(name: Column, pattern: str, strptime_format: str) -> Column:
    """Date written in a file name; NULL when absent or unreadable."""
    text = F.nullif(F.regexp_extract(name, checked_regex(pattern), 1), F.lit(""))
    return ntz(F.try_to_timestamp(text, F.lit(spark_date_pattern(strptime_format))))


def first_date_token(name: Column) -> Column:
    """First all-digit, eight-character part of the ``_``-separated stem, as a date."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    token = F.get(F.filter(F.split(stem, "_"), lambda part: part.rlike(r"^\d{8}$")), F.lit(0))
    return ntz(F.try_to_timestamp(token, F.lit("yyyyMMdd")))


def with_store_name_parts(df: DataFrame, name: str = "name") -> DataFrame:
    """base_name, time_res, zoom, start_date, end_date of a store name; all NULL if unreadable."""
    stem = F.regexp_replace(F.col(name), r"\.[^.]*$", "")
    full, short = stem.rlike(STORE_NAME), stem.rlike(STORE_NAME_NO_RES)

    def part(group_full: int, group_short: int) -> Column:
        return F.when(full, F.regexp_extract(stem, STORE_NAME, group_full)).when(
            short, F.regexp_extract(stem, STORE_NAME_NO_RES, group_short)
        )

    return df.withColumns(
        {
            "base_name": part(1, 1),
            "time_res": F.when(full, F.regexp_extract(stem, STORE_NAME, 2)),
            "zoom": part(3, 2).try_cast("int"),
            "start_date": part(4, 3),
            "end_date": part(5, 4),
        }
    )


def parse_store_name(name: str) -> dict:
    """Single store name on the driver; ValueError when it fits neither layout."""
    stem = re.sub(r"\.[^.]*$", "", name)
    if found := re.search(STORE_NAME, stem):
        base, res, zoom, start, end = found.groups()
    elif found := re.search(STORE_NAME_NO_RES, stem):
        (base, zoom, start, end), res = found.groups(), None
    else:
        raise ValueError(f"not a store name: {name!r}")
    return {"base_name": base, "time_res": res, "zoom": int(zoom), "start_date": start, "end_date": end}
