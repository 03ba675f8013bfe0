"""Money parsing and exact decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import types as T

# Storage type of one amount; the wider type that holds any sum of
# amounts for one transaction, however often its records are repeated; and the type of
# sums over transactions.
AMOUNT = "DECIMAL(18,2)"
TOTAL = "DECIMAL(28,2)"
GRAND_TOTAL = "DECIMAL(38,2)"

# Plain or exponent notation; Spark alone would also take '1d' and 'inf'.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
PAISE_SLACK = "0.00001D"
AMOUNT_CEILING = "1E13D"

# Processing fee by payment method, and tax as a share of the fee.
FEE_RATES = {"card": "0.0200", "upi": "0.0020", "net_banking": "0.0125", "wallet": "0.0150"}
TAX_SHARE = "0.18"


def as_number(name: str, dtype: T.DataType) -> str:
    """The value as a double, or null where it is not a number."""
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN regexp_like({name}, r'{NUMBER}') THEN try_cast({name} AS DOUBLE) END"
    if isinstance(dtype, T.NumericType):
        return f"CAST({name} AS DOUBLE)"
    raise ValueError(f"a {dtype.simpleString()} column cannot hold money")


def as_amount(name: str, dtype: T.DataType) -> str:
    if dtype == T.DecimalType(18, 2):
        return name
    if isinstance(dtype, (T.DecimalType, T.IntegralType)):
        return f"try_cast({name} AS {AMOUNT})"
    return f"try_cast({as_number(name, dtype)} AS {AMOUNT})"


def has_fractional_paise(number: str) -> str:
    return f"abs({number} * 100 - rint({number} * 100)) > {PAISE_SLACK}"


def fee_rate(payment_method: str) -> str:
    """Rate card as an expression: four fixed entries need no join."""
    entries = " ".join(f"WHEN '{method}' THEN {rate}" for method, rate in FEE_RATES.items())
    return f"CAST(CASE {payment_method} {entries} END AS DECIMAL(5,4))"


def fee_on(amount: str, rate: str) -> str:
    return f"CAST(round({amount} * {rate}, 2) AS {AMOUNT})"


def tax_on(fee: str) -> str:
    return f"CAST(round({fee} * {TAX_SHARE}, 2) AS {AMOUNT})"


def ratio(numerator: str, denominator: str) -> str:
    """Double division that is null for a zero denominator."""
    return f"(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D))"


def ratio_or_zero(numerator: str, denominator: str) -> str:
    return f"coalesce({ratio(numerator, denominator)}, 0D)"
