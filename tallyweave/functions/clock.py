"""UTC time handling without any dependence on the session time zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Shape of acceptable timestamp text, as a whole. A full calendar date is
# required, because Spark reads '12:30' as a time today and '2026' as a year. A zone is Z,
# UTC, GMT or an offset of two-digit hours and minutes; any other suffix makes the text
# invalid, because Spark would take the clock time and ignore what it cannot read.
CLOCK = r"\s*\d{4}-\d{2}-\d{2}[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"
ZONE = r"\s*([Zz]|UTC|GMT|[+-]\d{2}(:?\d{2})?)"
ZONED_TEXT = rf"^{CLOCK}{ZONE}\s*$"
LOCAL_TEXT = rf"^({CLOCK}|\s*\d{{4}}-\d{{2}}-\d{{2}})\s*$"

MICROS_PER_DAY = "86400000000D"


def as_utc(name: str, dtype: T.DataType) -> str:
    """Normalise text, date or timestamp to TIMESTAMP_NTZ in UTC; null if invalid."""
    if isinstance(dtype, T.TimestampNTZType):
        return name
    if isinstance(dtype, T.DateType):
        return f"CAST({name} AS TIMESTAMP_NTZ)"
    if isinstance(dtype, T.TimestampType):
        return _instant_as_utc(name)
    if isinstance(dtype, T.StringType):
        zoned = _instant_as_utc(f"try_cast({name} AS TIMESTAMP)")
        return (
            f"CASE WHEN regexp_like({name}, r'{ZONED_TEXT}') THEN {zoned} "
            f"WHEN regexp_like({name}, r'{LOCAL_TEXT}') THEN try_cast({name} AS TIMESTAMP_NTZ) END"
        )
    raise ValueError(f"a {dtype.simpleString()} column cannot hold event times")


def _instant_as_utc(instant: str) -> str:
    return f"timestampadd(MICROSECOND, unix_micros({instant}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def micros_between(start: str, end: str) -> str:
    return f"timestampdiff(MICROSECOND, {start}, {end})"


def days_between(start: str, end: str) -> str:
    """Elapsed days as a double, exact to the microsecond."""
    return f"({micros_between(start, end)} / {MICROS_PER_DAY})"


def first_not_before(moment: str, cutoffs: Sequence[str]) -> str:
    """The place, from 1, of the first of ascending cutoffs that is not before a moment; one more than there are if all are."""
    return f"1 + size(filter(array({', '.join(cutoffs)}), c -> c < {moment}))"
