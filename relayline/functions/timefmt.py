"""Time helpers: explicit ``as_of`` literals and the payload time formats."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_AS_OF = "2024-04-09 00:00:00"


def as_of_text(as_of) -> str:
    if as_of is None:
        raise ValueError("as_of is required: pass the reference time of the run")
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc)
        return as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(as_of, _dt.date):
        return as_of.strftime("%Y-%m-%d 00:00:00")
    return str(as_of)


def ts_lit(as_of) -> Column:
    """A TIMESTAMP_NTZ literal; constant-folded into the plan."""
    return F.lit(as_of_text(as_of)).cast("timestamp_ntz")


def days_before(as_of, days: int) -> Column:
    """``as_of - INTERVAL days DAYS`` as one literal."""
    return ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def date_days_before(as_of, days: int) -> Column:
    """``current_date() - INTERVAL days DAYS`` with the date taken from ``as_of``."""
    return F.to_date(ts_lit(as_of)) - F.expr(f"INTERVAL {int(days)} DAYS")


def _ltz(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def unix_seconds(c) -> Column:
    """Whole seconds since the epoch (UTC session)."""
    return F.unix_seconds(_ltz(c))


def unix_millis(c) -> Column:
    """Milliseconds since the epoch, floored."""
    return F.unix_millis(_ltz(c))


def iso_z(c) -> Column:
    """ISO-8601 text plus ``Z``; the fraction appears only when micros != 0."""
    c = _ltz(c)
    frac = F.date_format(c, "SSSSSS")
    return F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("Z"),
    )
