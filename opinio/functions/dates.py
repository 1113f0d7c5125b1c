"""Date, naming and log helpers.

Driver-side helpers only validate arguments; everything applied to rows is a
Column expression.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

class InvalidDate(ValueError):
    """An argument that should be a ``YYYY-MM-DD`` date is not one."""


def parse_iso_date(value: str) -> _dt.date:
    """``strptime(value, "%Y-%m-%d")``: ``2024-1-5`` is accepted (and
    normalised by ``iso``); padding, other layouts and impossible days raise."""
    if not isinstance(value, str):
        raise InvalidDate(f"invalid date {value!r}: use YYYY-MM-DD")
    try:
        return _dt.datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as exc:
        raise InvalidDate(f"invalid date {value!r}: use YYYY-MM-DD") from exc


def iso(value: str | _dt.date) -> str:
    """Normalise a date argument to its ISO text."""
    if isinstance(value, _dt.date):
        return value.isoformat()
    return parse_iso_date(value).isoformat()


def date_add_days(start: Column | str, days: Column) -> Column:
    """``start + days``."""
    start_col = F.to_date(F.lit(iso(start))) if isinstance(start, (str, _dt.date)) else start
    return F.date_add(start_col, days.cast("int"))


def date_prefix(c: Column) -> Column:
    """first ten characters of a date-like value, null-safe."""
    return F.substring(c.cast("string"), 1, 10)


def ceil_div(n: Column, size: int) -> Column:
    """number of batches of ``size`` rows."""
    return F.floor((n + F.lit(size - 1)) / F.lit(size)).cast("bigint")


def batch_name(batch_index: Column) -> Column:
    """0-based batch index -> ``batch_001``."""
    return F.format_string("batch_%03d", (batch_index + 1).cast("bigint"))


def coalesce_text(*parts: Column) -> Column:
    """the non-empty parts joined with `` | `` (empty string if none)."""
    return F.concat_ws(" | ", *[F.nullif(p, F.lit("")) for p in parts])


def elapsed_seconds(start: Column, stop: Column) -> Column:
    """``stop - start`` in seconds, floored at 0; rounded where it is shown."""
    micros = F.unix_micros(stop.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.greatest(F.lit(0.0), micros / F.lit(1e6))
