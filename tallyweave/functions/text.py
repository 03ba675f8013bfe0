"""Text tests and formatting."""

from __future__ import annotations

from collections.abc import Iterable

from tallyweave.functions import text_literal

# Every character that counts as blank space at the edge of a key.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Markup characters and the entities that stand for them, in the
# order of replacement (the ampersand must come first).
HTML_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def is_blank(value: str) -> str:
    """True for null, empty and whitespace-only text."""
    return f"({value} IS NULL OR TRIM(LEADING '{BLANK_CHARACTERS}' FROM {value}) = '')"


def html_escaped(value: str) -> str:
    for character, entity in HTML_ENTITIES:
        value = f"replace({value}, {text_literal(character)}, {text_literal(entity)})"
    return value


def joined_labels(labels: Iterable[tuple[str, str]], separator: str) -> str:
    """Labels whose condition holds, in alphabetical order, joined by a separator.

    ``concat_ws`` skips nulls, so an ordered string aggregate over a fixed label set
    becomes one expression on the row.
    """
    parts = [f"IF({condition}, {text_literal(label)}, NULL)" for label, condition in sorted(labels)]
    return f"concat_ws('{separator}', {', '.join(parts)})"


def grouped_thousands(value: str, decimals: int = 0) -> str:
    return f"format_number({value}, {decimals})"


def two_decimals(numerator, denominator) -> str:
    """The exact ratio of two whole numbers as text with two decimals; ties go to the even digit."""
    ratio = f"CAST({numerator} AS DECIMAL(19,0)) / CAST({denominator} AS DECIMAL(19,0))"
    return f"CAST(bround({ratio}, 2) AS STRING)"


def percentage(part: str, whole: str) -> str:
    """A share of counts in percent; null where there is nothing to share."""
    return f"IF({whole} = 0, NULL, concat({two_decimals(f'{part} * 100', whole)}, '%'))"
