"""Run parameters and the explicit reporting cutoff."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass
from datetime import date, datetime, timezone
from decimal import Decimal

# Default tolerances in rupees and settlement window in days.
DEFAULT_AMOUNT_TOLERANCE = 0.05
DEFAULT_FEE_TOLERANCE = 0.05
DEFAULT_MAX_SETTLEMENT_DAYS = 3.0


@dataclass(frozen=True)
class ReconciliationConfig:
    amount_tolerance: float = DEFAULT_AMOUNT_TOLERANCE
    fee_tolerance: float = DEFAULT_FEE_TOLERANCE
    max_settlement_days: float = DEFAULT_MAX_SETTLEMENT_DAYS

    def __post_init__(self):
        for name, value in asdict(self).items():
            if not math.isfinite(value) or value < 0:
                raise ValueError(f"{name} must be finite and nonnegative, got {value!r}")

    def amount_limit(self) -> str:
        return _six_decimals(self.amount_tolerance)

    def fee_limit(self) -> str:
        return _six_decimals(self.fee_tolerance)

    def settlement_days(self) -> str:
        return f"CAST('{float(self.max_settlement_days)}' AS DOUBLE)"

    def settlement_window(self) -> str:
        """The settlement window as a constant interval; fractions of a day count."""
        seconds = Decimal(str(self.max_settlement_days)) * 86400
        return f"make_dt_interval(0, 0, 0, CAST('{seconds}' AS DECIMAL(18,6)))"


def _six_decimals(value: float) -> str:
    return f"CAST('{Decimal(str(value))}' AS DECIMAL(18,6))"


def parse_cutoff(as_of) -> datetime:
    """Return the cutoff as a naive UTC datetime.

    Naive input means UTC, an offset is converted, and a bare date is midnight at
    the start of that day. The wall clock is never consulted.
    """
    if isinstance(as_of, datetime):
        moment = as_of
    elif isinstance(as_of, date):
        moment = datetime(as_of.year, as_of.month, as_of.day)
    elif isinstance(as_of, str):
        try:
            moment = datetime.fromisoformat(as_of.strip())
        except ValueError as error:
            raise ValueError(f"as_of is not a timestamp: {as_of!r}") from error
    else:
        raise ValueError("as_of must be given as a timestamp, a date or ISO text")
    if moment != moment:  # pandas.NaT is a datetime that equals nothing
        raise ValueError("as_of must not be missing")
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def cutoff_literal(as_of) -> str:
    """The cutoff as a TIMESTAMP_NTZ literal, so that the comparison reaches the scan."""
    return f"TIMESTAMP_NTZ'{parse_cutoff(as_of).isoformat(sep=' ', timespec='microseconds')}'"
