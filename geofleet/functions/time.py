"""Time helpers.

Storage is TIMESTAMP_NTZ holding UTC wall-clock time. Everything here is
written against the NTZ epoch with ``timestamp_diff`` / ``timestamp_add`` so
results do not depend on the session time zone (``date_trunc`` on NTZ returns
a zoned TIMESTAMP and would).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000

_EPOCH_NTZ = dt.datetime(1970, 1, 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(value: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime or 'YYYY-MM-DD HH:MM:SS' text."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(value))


def ntz_epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of an NTZ value read as UTC."""
    return F.timestamp_diff("MICROSECOND", ntz_literal(_EPOCH_NTZ), _col(c))


def ntz_epoch_millis(c: Column | str) -> Column:
    """Epoch milliseconds of an NTZ value read as UTC, sub-millisecond digits dropped."""
    return F.floor(ntz_epoch_micros(c) / F.lit(1000)).cast("bigint")


def epoch_millis_to_ntz(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC (the Connect Timestamp logical type)."""
    return F.timestamp_add("MILLISECOND", _col(ms).cast("bigint"), ntz_literal(_EPOCH_NTZ))


def instant_to_ntz(c: Column | str) -> Column:
    """A zoned TIMESTAMP -> its UTC wall-clock as TIMESTAMP_NTZ, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)), ntz_literal(_EPOCH_NTZ))


def floor_ntz(c: Column | str, unit_micros: int) -> Column:
    """Truncate an NTZ value to a multiple of ``unit_micros`` (minute, hour, day)."""
    micros = ntz_epoch_micros(c)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(unit_micros)), _col(c))


def minute_boundaries_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    This is the warehouse ``datediff('minute', a, b)``: 00:00:59 -> 01:01:00 is
    61, not the 60 elapsed minutes Spark's ``timestampdiff`` reports.
    """
    minute = F.lit(MICROS_PER_MINUTE)
    return (F.floor(ntz_epoch_micros(end) / minute) - F.floor(ntz_epoch_micros(start) / minute)).cast("bigint")


# ISO-8601 date, optional time, optional zone; extended or basic form.
ISO_DATE = r"(\d{4})-?(\d{2})-?(\d{2})"
ISO_TIME = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?"
ISO_ZONE = r"(Z|z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)"
ISO = f"^{ISO_DATE}(?:[Tt ]{ISO_TIME}{ISO_ZONE}?)?$"
# The extended form with seconds and an offset that a plain cast reads the same way in every session zone.
ISO_PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)$"


def iso_to_millis(text: Column | str) -> Column:
    """ISO-8601 text -> epoch milliseconds, whatever the session's zone.

    Extended and basic forms, a date alone (its midnight) included. Text
    without an offset is read as UTC. NULL if it names no time.
    """
    t = F.trim(_col(text))
    # Lazy: other forms alone are taken apart, in a lambda, whose code stays out of the compiled stage.
    other = F.get(F.transform(F.array(t), _any_iso_to_millis), 0)
    return F.when(t.rlike(ISO_PLAIN), F.floor(F.unix_micros(t.try_cast("timestamp")) / F.lit(1000)).cast("bigint")).otherwise(other)


def _any_iso_to_millis(t: Column) -> Column:
    part = lambda n: F.regexp_extract(t, ISO, n)
    two = lambda n: F.when(part(n) == "", "00").otherwise(part(n))
    micros = F.substring(F.concat(part(7), F.lit("000000")), 1, 6)
    local = F.concat(F.concat_ws("-", part(1), part(2), part(3)), F.lit(" "), F.concat_ws(":", two(4), two(5), two(6)),
                     F.lit("."), micros).try_cast("timestamp_ntz")
    zone = F.regexp_replace(part(8), ":", "")
    digits = lambda at: F.coalesce(F.substring(zone, at, 2).try_cast("int"), F.lit(0))
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    offset = F.when(zone.rlike("^[+-]"), sign * (digits(2) * 3600 + digits(4) * 60 + digits(6))).otherwise(0)
    return F.when(t.rlike(ISO), F.floor((ntz_epoch_micros(local) - offset.cast("bigint") * 1_000_000) / F.lit(1000)).cast("bigint"))


def reading_time_to_millis(text: Column | str, is_number: Column | None = None) -> Column:
    """Reading timestamp (JSON value as text) -> epoch milliseconds.

    A JSON number passes through as milliseconds (fraction truncated toward
    zero); a JSON text is ISO-8601, also if it is all digits (a basic date).
    ``is_number`` tells which it was; where it isn't given, no type is known
    and the value counts as a text. Unparseable input gives NULL.
    """
    number = F.trim(_col(text)).try_cast("double")
    as_text = iso_to_millis(text)
    return as_text if is_number is None else F.when(is_number & ~F.isnan(number), number.try_cast("bigint")).otherwise(as_text)


def iso_text(c: Column | str) -> Column:
    """ISO-8601 text of an NTZ value: seconds, plus '.ffffff' only when non-zero."""
    c = _col(c)
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(c.isNull(), None).when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))
