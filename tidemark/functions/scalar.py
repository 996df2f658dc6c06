"""Column expressions shared by the typing, staging and mart steps.

Everything here is a composition of built-in functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, strict: bool = True) -> Column:
    """Decimal text to an exact DECIMAL(12,2); null instead of an error when not strict."""
    c = _col(c)
    return (c.cast if strict else c.try_cast)("decimal(12,2)")


def iso_timestamp(c, strict: bool = True) -> Column:
    """ISO-8601 text to a timestamp cut to milliseconds."""
    c = _col(c)
    parsed = F.to_timestamp(c) if strict else F.try_to_timestamp(c)
    return F.date_trunc("MILLISECOND", parsed)


def millis_timestamp(c) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_col(c))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for a null condition)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def bool_to_int(c) -> Column:
    """A boolean as 0/1, null kept."""
    return _col(c).cast("int")


def in_day(c, day: str) -> Column:
    """Rows whose date or timestamp falls on a day, as a range so that it reaches the scan."""
    c = _col(c)
    start = F.lit(day).cast("date")
    return (c >= start) & (c < F.date_add(start, 1))


def age_seconds(created, updated) -> Column:
    """Seconds between two timestamps; null while the row has not moved."""
    created, updated = _col(created), _col(updated)
    seconds = F.unix_timestamp(updated) - F.unix_timestamp(created)
    return F.when(updated > created, seconds)


def line_total(quantity, unit_price) -> Column:
    """Quantity times the price paid, exact."""
    return (_col(quantity) * _col(unit_price)).cast("decimal(18,2)")


def month_key(c) -> Column:
    """yyyyMM of a date or timestamp as an integer."""
    c = _col(c)
    return F.year(c) * 100 + F.month(c)


def id_block(c, size: int = 1_000_000) -> Column:
    """Which block of consecutive ids a key falls in."""
    return F.call_function("div", _col(c), F.lit(size).cast("bigint"))


def placement(c, buckets: int) -> Column:
    """Hash bucket of a key; only for spreading rows, never compared with other engines."""
    return F.pmod(F.xxhash64(_col(c)), F.lit(buckets)).cast("int")


def signed_gap(left, right) -> Column:
    """left - right as a signed number."""
    return _col(left).cast("bigint") - _col(right).cast("bigint")


def days_since(day, as_of) -> Column:
    """Whole days from a date to the reporting date; null when there is no date."""
    return F.datediff(_col(as_of), _col(day))


def dt_from_path(path) -> Column:
    """Partition date out of a ``dt=YYYY-MM-DD`` path; null when the path has none."""
    text = F.regexp_extract(_col(path), r"dt=(\d{4}-\d{2}-\d{2})", 1)
    return F.when(text != "", text).try_cast("date")


def first_group(c, pattern: str) -> Column:
    """First capture group of the first match; null when nothing matches."""
    groups = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))
    return F.try_element_at(groups, F.lit(1))


def identity(*cols) -> Column:
    """Several columns joined to one slash-separated identity."""
    return F.concat_ws("/", *[_col(c).cast("string") for c in cols])


def any_after(times, as_of, interval: str) -> Column:
    """Does an array of timestamps hold one later than ``as_of - interval``?"""
    limit = _col(as_of) - F.expr(f"INTERVAL {interval}")
    return F.exists(_col(times), lambda t: t > limit)


def at_least(c, floor) -> Column:
    """The value, but never below ``floor``; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def ratio(num, den) -> Column:
    """num / den as a double, null for a zero denominator."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def ratio_of_sums(num, den) -> Column:
    """sum(num) / sum(den), null for a zero denominator: never an average of ratios."""
    return ratio(F.sum(_col(num)), F.sum(_col(den)))


def ntz(c) -> Column:
    """A timestamp as zone-less wall clock of the session zone (UTC)."""
    return _col(c).cast(T.TimestampNTZType())


def epoch_micros(c) -> Column:
    """Microseconds since the epoch, for zoned and zone-less timestamps alike."""
    return F.unix_micros(_col(c).cast("timestamp"))


def from_micros(c) -> Column:
    """The zone-less timestamp of an epoch-microsecond count."""
    return ntz(F.timestamp_micros(_col(c)))
