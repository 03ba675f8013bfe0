"""Running states of transactions over the intervals between cutoffs.

Every aggregate of a fact is algebraic: it follows from counts, sums, minima and maxima that can
be merged. An event is given to one interval only, that of the first cutoff which sees it. States are
aggregated per transaction and interval, and a prefix merge along the intervals of a
transaction gives its state at every cutoff at which something has changed. A state stays in force up
to the transaction's next interval, so the number of rows that are shuffled does not grow with the number of cutoffs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyweave.functions import aggregates, named
from tallyweave.functions.clock import first_not_before

#: How two states of an aggregate make one.
MERGED_BY = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
_CALL = re.compile(rf"\b({'|'.join(MERGED_BY)})\((\w+)\)")
INTERVAL, UNTIL = "_interval", "_until"


def decomposed(expressions: dict[str, str]) -> tuple[dict[str, tuple[str, str]], dict[str, str]]:
    """The mergeable states (name -> function, column) behind aggregate expressions, and the expressions over these states."""
    states = {f"_{function}_{column}": (function, column) for text in expressions.values() for function, column in _CALL.findall(text)}
    return states, {name: _CALL.sub(r"_\1_\2", text) for name, text in expressions.items()}


def states_by_interval(events: DataFrame, key: str, event_at: str, cutoffs: Sequence[str], states: dict[str, tuple[str, str]]) -> DataFrame:
    """(key, interval, states): the states of what each interval adds. Cutoffs are literals in ascending order; later events are left out."""
    placed = events.selectExpr("*", f"{first_not_before(event_at, cutoffs)} AS {INTERVAL}").filter(f"{INTERVAL} <= {len(cutoffs)}")
    return placed.groupBy(key, INTERVAL).agg(*aggregates({name: f"{function}({column})" for name, (function, column) in states.items()}))


def merged_along(added: DataFrame, key: str, states: dict[str, tuple[str, str]], last: int) -> DataFrame:
    """(key, interval, until, states): the states of all intervals so far, in force from interval up to until.

    A key has at most as many rows as there are cutoffs, so its window is small however often it occurs in the feeds.
    """
    types = {f.name: f.dataType.simpleString() for f in added.schema}
    order = f"PARTITION BY {key} ORDER BY {INTERVAL}"
    running = {
        name: f"CAST({MERGED_BY[function]}({name}) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {types[name]})"
        for name, (function, _) in states.items()
    }
    return added.selectExpr(key, INTERVAL, f"lead({INTERVAL}, 1, {last + 1}) OVER ({order}) - 1 AS {UNTIL}", *named(running))


def at_cutoffs(merged: DataFrame, cutoffs: Sequence[str], expressions: dict[str, str], key: str) -> DataFrame:
    """(as_of, key, expressions) for every cutoff that a state is in force at; row by row, above all shuffles."""
    moments = f"slice(array({', '.join(cutoffs)}), {INTERVAL}, {UNTIL} - {INTERVAL} + 1)"
    return merged.selectExpr(f"explode({moments}) AS as_of", key, *named(expressions))


def prefix_merged(events: DataFrame, key: str, event_at: str, cutoffs: Sequence[str], expressions: dict[str, str]) -> DataFrame:
    """(as_of, key, aggregate expressions over all events up to as_of) for every cutoff and every key seen by then."""
    states, over_states = decomposed(expressions)
    added = states_by_interval(events, key, event_at, cutoffs, states)
    return at_cutoffs(merged_along(added, key, states, len(cutoffs)), cutoffs, over_states, key)
