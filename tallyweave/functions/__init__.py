"""SQL expressions shared by the operators, as text. All are JVM built-ins.

Expressions are composed as SQL text and handed to ``selectExpr``, ``filter`` and
``expr``. A wide relation then costs one call into the JVM instead of hundreds, and
the plans are the same.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(expressions: Mapping[str, str]) -> list[str]:
    """Select-list items for a name -> expression mapping."""
    return [f"{expression} AS {name}" for name, expression in expressions.items()]


def aggregates(expressions: Mapping[str, str]) -> list[Column]:
    return [F.expr(item) for item in named(expressions)]


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
