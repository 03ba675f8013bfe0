"""What each feed must provide. Only these columns ever reach detection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyweave.config import cutoff_literal
from tallyweave.functions import named
from tallyweave.functions.clock import as_utc
from tallyweave.functions.money import as_amount
from tallyweave.functions.text import is_blank

UNKNOWN = "unknown"
MULTIPLE = "multiple"
CURRENCY = "INR"


@dataclass(frozen=True)
class FeedContract:
    name: str
    text: tuple[str, ...]
    time: str
    money: tuple[str, ...]
    status: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.text, self.time, *self.money)

    def require(self, feed: DataFrame) -> None:
        missing = sorted(set(self.columns) - set(feed.columns))
        if missing:
            raise ValueError(f"{self.name} missing columns: {missing}")


# Feed names and their columns.
INTERNAL = FeedContract(
    "internal",
    text=("transaction_id", "order_id", "merchant_id", "payment_method", "currency", "internal_status"),
    time="created_at",
    money=("gross_amount",),
    status="internal_status",
)
GATEWAY = FeedContract(
    "gateway",
    text=("transaction_id", "gateway_record_id", "gateway_status"),
    time="gateway_event_at",
    money=("gateway_amount", "gateway_fee", "gateway_tax", "gateway_net"),
    status="gateway_status",
)
SETTLEMENT = FeedContract(
    "settlement",
    text=("transaction_id", "settlement_line_id"),
    time="settled_at",
    money=("gross_amount", "fee_amount", "tax_amount", "net_amount"),
)
CONTRACTS = (INTERNAL, GATEWAY, SETTLEMENT)

# The narrower ledger contract of the ten-rule detector.
LEGACY_INTERNAL = FeedContract(
    "internal",
    text=("transaction_id", "order_id", "internal_status"),
    time="created_at",
    money=("gross_amount",),
    status="internal_status",
)
LEGACY_CONTRACTS = (LEGACY_INTERNAL, GATEWAY, SETTLEMENT)


def typed(feed: DataFrame, contract: FeedContract, *, lower_status: bool = True) -> DataFrame:
    """Project a feed to its contract with text keys, UTC times and exact decimals.

    Keys keep their exact text, including surrounding blanks and literals such as
    ``NA``. Labels or any other extra columns are dropped here.
    """
    contract.require(feed)
    types = {field.name: field.dataType for field in feed.schema}
    columns = {}
    for name in contract.text:
        value = f"CAST({name} AS STRING)"
        columns[name] = f"lower({value})" if lower_status and name == contract.status else value
    columns[contract.time] = as_utc(contract.time, types[contract.time])
    columns.update({name: as_amount(name, types[name]) for name in contract.money})
    if contract.name == GATEWAY.name:
        columns["gateway_id"] = provider(feed)
    return feed.selectExpr(*named(columns))


def provider(feed: DataFrame) -> str:
    """Optional provider column: absent, null and blank all mean unknown."""
    if "gateway_id" not in feed.columns:
        return f"'{UNKNOWN}'"
    value = "CAST(gateway_id AS STRING)"
    return f"IF({is_blank(value)}, '{UNKNOWN}', {value})"


def until(feed: DataFrame, contract: FeedContract, as_of) -> DataFrame:
    """Keep events up to and including the cutoff."""
    return feed.filter(f"{contract.time} <= {cutoff_literal(as_of)}")
