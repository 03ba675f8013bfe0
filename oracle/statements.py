"""Oracle statement of every registered query that SQL can express."""

from __future__ import annotations

from oracle.relations import AS_OF, CORE, COUNTS, RULE_NAMES, SUMS, relations

FACT_COLUMNS = (
    "transaction_id has_internal merchant_id payment_method gateway_id t:activity_at t:created_at internal_status "
    "m:internal_gross gateway_rows settlement_rows t:gateway_event_at gateway_status t:settled_at "
    "m:gateway_gross_total m:gateway_net_total m:bank_gross_total m:bank_net_total m:gateway_amount m:gateway_net "
    "m:gateway_fee m:gateway_tax m:bank_gross m:bank_net m:bank_fee m:bank_tax m:gateway_duplicate_excess "
    "m:settlement_duplicate_excess t:as_of r:max_settlement_days m:amount_tolerance m:fee_tolerance d:activity_date "
    "t:settlement_due_at r:elapsed_days r:settlement_delay_days settlement_eligible m:ledger_gateway_gross_delta "
    "m:gateway_bank_gross_delta m:gateway_bank_net_delta m:fee_tax_abs_delta"
)
EXPOSURES = "m:financial_exposure_inr m:overdue_cash_inr m:historical_late_cash_inr"
STATE_COLUMNS = f"exception_count exception_types {EXPOSURES} settlement_state reconciliation_state"
SIGNAL_COLUMNS = "transaction_id exception_type severity m:amount_at_risk exposure_kind reason"
QUEUE_COLUMNS = (
    f"priority_rank transaction_id merchant_id payment_method gateway_id exception_types exception_count severity "
    f"case_status {EXPOSURES} m:current_exposure_inr r:age_days recommended_actions r:priority_score aging_bucket"
)
METRIC_COLUMNS = " ".join(
    [
        "dimension_value",
        *COUNTS,
        *[f"m:{name}" for name in SUMS],
        "r:exception_transaction_rate r:internal_exception_rate r:exposure_share r:exception_share",
    ]
)
SUMMARY_COLUMNS = (
    "observed_transactions internal_payments orphan_transactions exception_count exception_transactions "
    "r:exception_transaction_rate r:internal_exception_rate matched_payments pending_payments overdue_payments "
    "m:internal_gross_inr m:gateway_gross_inr m:gateway_net_inr m:bank_gross_inr m:bank_net_inr "
    f"{EXPOSURES} m:current_exposure_inr"
)
CONTROL_COLUMNS = "m:internal_gross_inr m:gateway_gross_inr m:gateway_net_inr m:bank_gross_inr m:bank_net_inr"


def shown(columns: str, source: str = "") -> str:
    """Columns at the query's edge: m money, r rounded double, t time, d date."""
    forms = {
        "m": "CAST({c} AS DOUBLE)",
        "r": "round({c}, 6)",
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
        "d": "CAST({c} AS VARCHAR)",
    }
    out = []
    for item in columns.split():
        kind, _, name = item.rpartition(":")
        column = f"{source}.{name}" if source else name
        out.append(f"{forms[kind].format(c=column) if kind else column} AS {name}")
    return ", ".join(out)


def _select(columns: str, relation: str, tail: str = "", as_of: str = AS_OF) -> str:
    return f"{relations(as_of)} SELECT {shown(columns)} FROM {relation} {tail}"


def _metric_view(dimension: str, columns: str = METRIC_COLUMNS) -> str:
    return _select(columns, "dims", f"WHERE dimension = '{dimension}'")


def _bars(relation: str, label: str, value: str, shown_value: str) -> str:
    escaped = label
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        escaped = f"replace({escaped}, '{character}', '{entity}')"
    return f"""{relations()}, head AS (SELECT {label}, {value} FROM {relation} ORDER BY {value} DESC, {label} LIMIT 10)
        SELECT {label}, {escaped} AS label_html, {shown_value} AS {value},
               round(CAST({value} AS DOUBLE) / greatest((SELECT CAST(max({value}) AS DOUBLE) FROM head), 1) * 100, 6)
                 AS bar_percent
        FROM head"""


def _legacy_signals() -> str:
    """The ten-rule detector from anti-joins and joins of unique records, without a cutoff."""
    return """,
rep_g AS (SELECT transaction_id, count(*) AS n, max(gateway_amount) AS amount FROM gateway_all
          GROUP BY transaction_id HAVING count(*) > 1),
rep_s AS (SELECT transaction_id, count(*) AS n, max(net_amount) AS amount FROM settlement_all
          GROUP BY transaction_id HAVING count(*) > 1),
ug AS (SELECT * FROM gateway_all ANTI JOIN rep_g USING (transaction_id)),
us AS (SELECT transaction_id, settled_at, net_amount, fee_amount, tax_amount
       FROM settlement_all ANTI JOIN rep_s USING (transaction_id)),
pairs AS (SELECT internal_all.*, ug.* EXCLUDE (transaction_id) FROM internal_all JOIN ug USING (transaction_id)),
paid AS (SELECT ug.*, us.* EXCLUDE (transaction_id),
                (epoch_us(settled_at) - epoch_us(gateway_event_at)) / 86400000000.0::DOUBLE AS days,
                abs(gateway_fee - fee_amount) + abs(gateway_tax - tax_amount) AS gap
         FROM ug JOIN us USING (transaction_id) WHERE lower(gateway_status) = 'success'),
legacy(exception_type, transaction_id, severity, amount_at_risk, exposure_kind, reason) AS (
  SELECT 'duplicate_gateway', transaction_id, 'critical', amount, 'potential_loss',
         n || ' gateway records share the same transaction_id.' FROM rep_g
  UNION ALL SELECT 'duplicate_settlement', transaction_id, 'critical', amount, 'potential_loss',
         n || ' settlement lines share the same transaction_id.' FROM rep_s
  UNION ALL SELECT 'missing_gateway', transaction_id, 'high', gross_amount, 'potential_loss',
         'Internal payment exists but no gateway record was found.'
         FROM internal_all ANTI JOIN gateway_all USING (transaction_id)
  UNION ALL SELECT 'orphan_gateway', transaction_id, 'high', gateway_amount, 'potential_loss',
         'Gateway transaction has no matching internal payment.' FROM ug ANTI JOIN internal_all USING (transaction_id)
  UNION ALL SELECT 'orphan_settlement', transaction_id, 'critical', net_amount, 'potential_loss',
         'Settlement line has no matching internal payment.' FROM us ANTI JOIN internal_all USING (transaction_id)
  UNION ALL SELECT 'amount_mismatch', transaction_id, 'high', abs(gross_amount - gateway_amount), 'potential_loss',
         'Internal gross ' || gross_amount || ' differs from gateway amount ' || gateway_amount || '.'
         FROM pairs WHERE abs(gross_amount - gateway_amount) > 0.05
  UNION ALL SELECT 'status_mismatch', transaction_id, 'high', gross_amount, 'data_integrity',
         'Internal status ' || internal_status || ' differs from gateway status ' || gateway_status || '.'
         FROM pairs WHERE lower(internal_status) <> lower(gateway_status)
  UNION ALL SELECT 'missing_settlement', transaction_id, 'critical', gateway_net, 'potential_loss',
         'Successful payment has no bank settlement line.'
         FROM pairs ANTI JOIN settlement_all USING (transaction_id)
         WHERE lower(internal_status) = 'success' AND lower(gateway_status) = 'success'
  UNION ALL SELECT 'fee_mismatch', transaction_id, 'medium', gap, 'potential_loss',
         'Bank-reported fee/tax differs from gateway fee/tax.' FROM paid WHERE gap > 0.05
  UNION ALL SELECT 'settlement_delay', transaction_id, 'medium', gateway_net, 'cash_timing',
         printf('Settlement occurred after %.2f days; maximum allowed is %.2f.', days, 3.0::DOUBLE)
         FROM paid WHERE days > 3
)"""


def _evaluation() -> str:
    return f""",
found AS (SELECT DISTINCT exception_type, transaction_id, amount_at_risk FROM detected
          WHERE exception_type IN ({CORE})),
compared AS (
  SELECT exception_type, transaction_id, reference_amount, amount_at_risk,
         truth.transaction_id IS NOT NULL AS truth_present, found.transaction_id IS NOT NULL AS detected_present,
         CASE WHEN truth.transaction_id IS NULL THEN 'fp' WHEN found.transaction_id IS NULL THEN 'fn'
              ELSE 'tp' END AS outcome
  FROM truth FULL JOIN found USING (exception_type, transaction_id)
)"""


_OUTCOMES = ", ".join(f"count(*) FILTER (WHERE outcome = '{o}') AS {o}" for o in ("tp", "fp", "fn"))
_SCORES = """
    ifnull(round(tp / nullif(tp + fp, 0), 6), 0) AS precision, ifnull(round(tp / nullif(tp + fn, 0), 6), 0) AS recall,
    ifnull(round(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
      / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 6), 0) AS f1"""


def _fingerprint() -> str:
    """Rows and the sum of 60-bit row hashes over name=value texts in order of name."""
    forms = {"r": "CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)", "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"}
    cells = []
    for item in sorted(FACT_COLUMNS.split(), key=lambda x: x.rpartition(":")[2]):
        kind, _, name = item.rpartition(":")
        text = forms.get(kind, "CAST({c} AS VARCHAR)").format(c=name)
        cells.append(f"'{name}=' || ifnull('v' || {text}, 'null')")
    row = f"CAST('0x' || left(md5({' || chr(124) || '.join(cells)}), 15) AS BIGINT)"
    return (
        f"{relations()} SELECT 'payment_facts' AS table_name, count(*) AS rows, "
        f"CAST(CAST(ifnull(sum({row}), 0) AS HUGEINT) AS VARCHAR) AS content_hash FROM facts"
    )


def _changed_ranges() -> str:
    """Ranges between every 256th part of the 4096 ids with the least MD5 that hold a changed or missing id."""
    return f"""{relations()},
        ids AS (SELECT transaction_id AS id, left(md5('change' || transaction_id), 3) AS mark FROM facts),
        drawn AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place, count(*) OVER () AS n
                  FROM (SELECT id FROM ids ORDER BY md5(id), id LIMIT 4096)),
        borders AS (SELECT id AS border, row_number() OVER (ORDER BY id) AS node FROM drawn
                    WHERE place IN (SELECT k * n // 256 FROM (SELECT any_value(n) AS n FROM drawn), range(1, 256) AS r(k))),
        placed AS (SELECT mark, (SELECT count(*) FROM borders WHERE border <= id) AS node FROM ids)
        SELECT CAST(p.node AS BIGINT) AS node, any_value(b.border) AS from_key, any_value(e.border) AS until_key,
               count(*) AS rows_before, count(*) FILTER (mark <> '003') AS rows_after
        FROM placed p LEFT JOIN borders b ON b.node = p.node LEFT JOIN borders e ON e.node = p.node + 1
        GROUP BY p.node HAVING bool_or(mark <= '003')"""


def _quarter_ends() -> list[str]:
    return [f"{year}-{day} 23:59:59" for year in range(1993, 1999) for day in ("03-31", "06-30", "09-30", "12-31")]


def _snapshots(moments) -> str:
    """Each cutoff on its own, from the start."""
    one_by_one = []
    for moment in moments:
        statement = _select(SUMMARY_COLUMNS, "totals", as_of=f"TIMESTAMP '{moment}'")
        one_by_one.append(f"SELECT '{moment}' AS as_of, * FROM ({statement})")
    return " UNION ALL ".join(one_by_one)


_TIED = (
    "observed_transactions internal_payments exception_count exception_transactions internal_gross_inr gateway_net_inr "
    "bank_net_inr current_exposure_inr historical_late_cash_inr"
).split()
_FEED_TIMES = {"internal": "created_at", "gateway": "gateway_event_at", "settlement": "settled_at"}
_FEED_AMOUNTS = {"internal": "gross_amount", "gateway": "gateway_amount", "settlement": "gross_amount"}


def _source_counts() -> str:
    return f"{relations()} " + " UNION ALL ".join(
        f"SELECT '{feed}' AS feed, count(*) AS input_rows, count(*) FILTER (WHERE {t} <= {AS_OF}) AS included_rows, "
        f"count(*) FILTER (WHERE NOT {t} <= {AS_OF}) AS future_rows_excluded FROM {feed}_all"
        for feed, t in _FEED_TIMES.items()
    )


def _csv_round_trip() -> str:
    return f"{relations()} " + " UNION ALL ".join(
        f"SELECT '{feed}' AS feed, count(*) AS rows, count(DISTINCT transaction_id) AS transactions, "
        f"CAST(sum({_FEED_AMOUNTS[feed]}) AS DOUBLE) AS amount, "
        f"strftime(max({t}), '%Y-%m-%d %H:%M:%S') AS latest FROM {feed}"
        for feed, t in _FEED_TIMES.items()
    )


_TEXT_COLUMNS = {
    "internal": "transaction_id order_id merchant_id payment_method currency internal_status",
    "gateway": "transaction_id gateway_record_id gateway_status",
    "settlement": "transaction_id settlement_line_id",
}
_MONEY_COLUMNS = {
    "internal": "gross_amount",
    "gateway": "gateway_amount gateway_fee gateway_tax gateway_net",
    "settlement": "gross_amount fee_amount tax_amount net_amount",
}


def _validation_report() -> str:
    parts = []

    def check(feed: str, name: str, column: str, bad: str) -> None:
        parts.append(
            f"SELECT '{feed}' AS feed, '{name}' AS \"check\", '{column}' AS column_name, "
            f"count(*) FILTER (WHERE {bad}) AS violations FROM {feed}_all"
        )

    for feed, time in _FEED_TIMES.items():
        for column in _TEXT_COLUMNS[feed].split():
            check(feed, "blank_text", column, f"{column} IS NULL OR trim({column}) = ''")
        check(feed, "invalid_time", time, f"{time} IS NULL")
        for column in _MONEY_COLUMNS[feed].split():
            check(feed, "not_finite", column, f"{column} IS NULL")
            check(feed, "negative", column, f"{column} < 0")
            check(feed, "fractional_paise", column, f"{column} * 100 <> trunc({column} * 100)")
            check(feed, "too_large", column, f"{column} >= 10000000000000")
    check("internal", "foreign_currency", "currency", "currency <> 'INR'")
    parts.append(
        "SELECT 'internal', 'duplicate_key', 'transaction_id', count(*) FROM "
        "(SELECT transaction_id FROM internal_all GROUP BY 1 HAVING count(*) > 1)"
    )
    return f"{relations()} " + " UNION ALL ".join(parts)


def _faulty_ledger_report() -> str:
    """Expected violations of the faulty ledger, counted from its cases alone."""
    where = {
        ("blank_text", "merchant_id"): "c IN (20, 28)",
        ("foreign_currency", "currency"): "c = 21",
        ("invalid_time", "created_at"): "c IN (22, 29)",
        ("not_finite", "gross_amount"): "c IN (23, 30)",
        ("negative", "gross_amount"): "c = 24",
        ("fractional_paise", "gross_amount"): "c = 25",
        ("too_large", "gross_amount"): "c = 26",
        ("duplicate_key", "transaction_id"): "c = 27",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{column}' AS column_name, count(*) FILTER (WHERE {bad}) AS violations FROM base"
        for (check, column), bad in where.items()
    )
    return f"{relations()} SELECT 'internal' AS feed, * FROM ({rows}) WHERE violations > 0"


def _expected_fees() -> str:
    return f"""{relations()}, priced AS (
          SELECT *, CAST(round(gross_amount * fee_rate, 2) AS DECIMAL(18,2)) AS expected_fee FROM (
            SELECT *, CAST(CASE payment_method WHEN 'card' THEN 0.02 WHEN 'upi' THEN 0.002
                           WHEN 'net_banking' THEN 0.0125 WHEN 'wallet' THEN 0.015 END AS DECIMAL(5,4)) AS fee_rate
            FROM internal)),
        priced2 AS (SELECT *, CAST(round(expected_fee * 0.18, 2) AS DECIMAL(18,2)) AS expected_tax FROM priced)
        SELECT transaction_id, payment_method, {shown("m:gross_amount m:fee_rate m:expected_fee m:expected_tax")},
               CAST(gross_amount - expected_fee - expected_tax AS DOUBLE) AS expected_net FROM priced2"""


def _fee_variance() -> str:
    """The gateway charges by the card, so every single matched record is on schedule."""
    return f"""{relations()}, single AS (SELECT * FROM gateway ANTI JOIN
            (SELECT transaction_id FROM gateway GROUP BY 1 HAVING count(*) > 1) USING (transaction_id)),
        priced AS (SELECT internal.payment_method, single.*, CAST(round(gateway_amount * CASE payment_method
              WHEN 'card' THEN 0.0200 WHEN 'upi' THEN 0.0020 WHEN 'net_banking' THEN 0.0125 ELSE 0.0150 END, 2)
              AS DECIMAL(18,2)) AS expected_fee FROM single JOIN internal USING (transaction_id)),
        taxed2 AS (SELECT *, CAST(round(expected_fee * 0.18, 2) AS DECIMAL(18,2)) AS expected_tax FROM priced)
        SELECT transaction_id, payment_method, {shown("m:expected_fee m:gateway_fee")},
               CAST(gateway_fee - expected_fee AS DOUBLE) AS fee_variance,
               CAST(gateway_tax - expected_tax AS DOUBLE) AS tax_variance,
               CAST(gateway_net - (gateway_amount - expected_fee - expected_tax) AS DOUBLE) AS net_variance
        FROM taxed2"""


def _tie_out() -> str:
    sums = ", ".join(f"CAST(sum({m}) AS DECIMAL(38,2)) AS {m}" for m in _TIED)
    return f"""{relations()}, long AS (UNPIVOT (SELECT dimension, {sums} FROM dims GROUP BY dimension)
            ON {", ".join(_TIED)} INTO NAME measure VALUE total)
        SELECT part.dimension, part.measure, CAST(part.total AS DOUBLE) AS dimension_total,
               CAST(whole.total AS DOUBLE) AS summary_total, part.total = whole.total AS ties
        FROM long AS part JOIN long AS whole ON part.measure = whole.measure AND whole.dimension = 'all'
        WHERE part.dimension <> 'all'"""


def _report_rows() -> str:
    tables = {
        "reconciliation_facts": "recon",
        "detected_exceptions": "detected",
        "investigation_queue": "queue",
        "summary": "totals",
        "merchant_metrics": "dims WHERE dimension = 'merchant'",
        "daily_metrics": "dims WHERE dimension = 'day'",
        "payment_method_metrics": "dims WHERE dimension = 'payment_method'",
        "gateway_metrics": "dims WHERE dimension = 'gateway'",
        "exception_type_metrics": "(SELECT DISTINCT exception_type FROM detected)",
        "aging_metrics": "(SELECT DISTINCT case_status, aging_bucket FROM cases)",
        "settlement_delay_metrics": "(SELECT DISTINCT gateway_id FROM recon)",
        "daily_settlements": "(SELECT DISTINCT CAST(settled_at AS DATE) FROM settlement)",
    }
    return f"{relations()} " + " UNION ALL ".join(
        f"SELECT '{name}' AS report, count(*) AS rows FROM {source}" for name, source in tables.items()
    )


_CARDS = (
    ("Internal payments", "internal_payments", "format('{:,}', internal_payments)"),
    (
        "Payments with exceptions (all sources)",
        "exception_transactions",
        "format('{:,}', exception_transactions)",
    ),
    ("Rule signals", "exception_count", "format('{:,}', exception_count)"),
    ("Current estimated exposure", "current_exposure_inr", None),
    ("Of which: overdue cash", "overdue_cash_inr", None),
    ("Historical late cash · excluded from current", "historical_late_cash_inr", None),
)


def _report_cards() -> str:
    return f"{relations()} " + " UNION ALL ".join(
        f"SELECT CAST({n} AS BIGINT) AS position, '{label}' AS card, CAST({column} AS DOUBLE) AS value, "
        + (display or f"'₹' || format('{{:,.2f}}', CAST({column} AS DOUBLE))")
        + " AS display FROM totals"
        for n, (label, column, display) in enumerate(_CARDS, start=1)
    )


def _deduplicated() -> str:
    parts = []
    for feed, amount in (("gateway", "gateway_amount"), ("settlement", "net_amount")):
        for method in ("grouping", "anti_join"):
            parts.append(
                f"SELECT '{feed}' AS feed, '{method}' AS method, count(*) AS rows, CAST(sum({amount}) AS DOUBLE) AS amount "
                f"FROM (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS copies FROM {feed}_all) WHERE copies = 1"
            )
    return f"{relations()} " + " UNION ALL ".join(parts)


def statements() -> dict[str, str]:
    legacy, evaluated = relations() + _legacy_signals(), relations() + _evaluation()
    detected = f"{SIGNAL_COLUMNS} merchant_id payment_method gateway_id d:activity_date case_status r:age_days {EXPOSURES}"
    compared = "exception_type, transaction_id, severity, CAST(amount_at_risk AS DECIMAL(38,2)) AS amount_at_risk, exposure_kind"
    found = {
        "feed_internal": _select(
            "transaction_id order_id merchant_id payment_method currency internal_status t:created_at m:gross_amount",
            "internal",
        ),
        "feed_gateway": _select(
            "transaction_id gateway_record_id gateway_status t:gateway_event_at m:gateway_amount m:gateway_fee "
            "m:gateway_tax m:gateway_net gateway_id",
            "gateway",
        ),
        "feed_settlement": _select(
            "transaction_id settlement_line_id t:settled_at m:gross_amount m:fee_amount m:tax_amount m:net_amount",
            "settlement",
        ),
        "csv_round_trip": _csv_round_trip(),
        "source_counts": _source_counts(),
        "validation_report": _validation_report(),
        "validation_faults": _faulty_ledger_report(),
        "gateway_rollup": _select(
            "transaction_id gateway_rows gateway_id t:gateway_event_at gateway_status m:gateway_gross_total "
            "m:gateway_net_total m:gateway_amount m:gateway_net m:gateway_fee m:gateway_tax m:gateway_duplicate_excess",
            "g",
        ),
        "settlement_rollup": _select(
            "transaction_id settlement_rows t:settled_at m:bank_gross_total m:bank_net_total m:bank_gross m:bank_net "
            "m:bank_fee m:bank_tax m:settlement_duplicate_excess",
            "s",
        ),
        "payment_facts": _select(FACT_COLUMNS, "facts"),
        "table_fingerprint": _fingerprint(),
        "fingerprint_difference": _changed_ranges(),
        "facts_by_joins": _select(FACT_COLUMNS, "facts"),
        "exception_signals": _select(SIGNAL_COLUMNS, "detected"),
        **{
            f"signals_{name}": _select(SIGNAL_COLUMNS, "detected", f"WHERE exception_type = '{name}'")
            for name in RULE_NAMES
        },
        "detected_exceptions": _select(f"{detected} recommended_action", "detected"),
        "exception_rollup": _select(
            "transaction_id exception_count exception_types severity_rank r:age_days "
            f"{EXPOSURES} recommended_actions historical_only",
            "rollup",
        ).replace("severity_rank AS severity_rank", "CAST(severity_rank AS BIGINT) AS severity_rank"),
        "reconciliation_facts": _select(f"{FACT_COLUMNS} {STATE_COLUMNS}", "recon"),
        "investigation_queue": _select(QUEUE_COLUMNS, "queue"),
        "queue_top25": _select(QUEUE_COLUMNS, "queue", "WHERE priority_rank <= 25"),
        "top10_merchants": _bars(
            "(FROM dims WHERE dimension = 'merchant')",
            "dimension_value",
            "current_exposure_inr",
            "CAST(current_exposure_inr AS DOUBLE)",
        ),
        "top10_rules": _bars(
            "(SELECT exception_type, count(*) AS exception_count FROM detected GROUP BY 1)",
            "exception_type",
            "exception_count",
            "exception_count",
        ),
        "first10_days": _select(
            "dimension_value internal_payments exception_count exception_transactions r:exception_transaction_rate "
            "m:current_exposure_inr m:overdue_cash_inr",
            "dims",
            "WHERE dimension = 'day' ORDER BY dims.dimension_value LIMIT 10",
        ),
        "dimension_metrics": _select(f"dimension {METRIC_COLUMNS}", "dims"),
        "dimension_metrics_by_cells": _select(f"dimension {METRIC_COLUMNS}", "dims"),
        "merchant_metrics": _metric_view("merchant"),
        "daily_metrics": _metric_view("day"),
        "payment_method_metrics": _metric_view("payment_method"),
        "gateway_metrics": _metric_view("gateway"),
        "payment_method_concentration": _metric_view(
            "payment_method",
            "dimension_value observed_transactions exception_transactions r:exception_transaction_rate "
            "m:current_exposure_inr r:exposure_share",
        ),
        "summary": _select(SUMMARY_COLUMNS, "totals"),
        "summary_empty": _select(SUMMARY_COLUMNS, "totals", as_of="TIMESTAMP '1990-01-01 00:00:00'"),
        "source_controls": _select(CONTROL_COLUMNS, "totals"),
        "exception_type_metrics": f"""{relations()}
            SELECT exception_type, severity, exposure_kind, count(*) AS exception_count,
                   round(count(*)::DOUBLE / nullif((SELECT count(*) FROM facts), 0), 6) AS observed_transaction_rate,
                   CAST(sum(amount_at_risk) AS DOUBLE) AS rule_amount_at_risk_inr,
                   CAST(sum(financial_exposure_inr) AS DOUBLE) AS rule_financial_exposure_inr,
                   CAST(sum(overdue_cash_inr) AS DOUBLE) AS overdue_cash_inr,
                   CAST(sum(historical_late_cash_inr) AS DOUBLE) AS historical_late_cash_inr
            FROM detected GROUP BY ALL""",
        "aging_metrics": f"""{relations()}
            SELECT case_status, aging_bucket, count(*) AS investigation_count,
                   CAST(sum(financial_exposure_inr) AS DOUBLE) AS financial_exposure_inr,
                   CAST(sum(overdue_cash_inr) AS DOUBLE) AS overdue_cash_inr,
                   CAST(sum(current_exposure_inr) AS DOUBLE) AS current_exposure_inr,
                   CAST(sum(historical_late_cash_inr) AS DOUBLE) AS historical_late_cash_inr
            FROM cases GROUP BY ALL""",
        "settlement_delay_metrics": f"""{relations()}
            SELECT gateway_id, count(settlement_delay_days) AS observed_unique_settlements,
                   count(*) FILTER (WHERE settlement_delay_days > 3) AS late_settlements,
                   round(avg(settlement_delay_days), 6) AS mean_delay_days,
                   round(median(settlement_delay_days), 6) AS median_delay_days,
                   round(quantile_cont(settlement_delay_days, 0.95), 6) AS p95_delay_days,
                   round(max(settlement_delay_days), 6) AS max_delay_days,
                   count(*) FILTER (WHERE settlement_state = 'overdue') AS overdue_payments,
                   count(*) FILTER (WHERE settlement_state = 'pending') AS pending_payments
            FROM recon GROUP BY gateway_id""",
        "daily_settlements": f"""{relations()}
            SELECT CAST(CAST(settled_at AS DATE) AS VARCHAR) AS settlement_date, count(*) AS settlement_lines,
                   count(DISTINCT transaction_id) AS settled_transactions,
                   CAST(sum(gross_amount) AS DOUBLE) AS bank_gross_inr, CAST(sum(fee_amount) AS DOUBLE) AS bank_fee_inr,
                   CAST(sum(tax_amount) AS DOUBLE) AS bank_tax_inr, CAST(sum(net_amount) AS DOUBLE) AS bank_net_inr
            FROM settlement GROUP BY 1""",
        "dimension_tie_out": _tie_out(),
        "duplicate_ids": f"""{relations()}
            SELECT 'gateway' AS feed, transaction_id, count(*) AS rows FROM gateway_all GROUP BY 2 HAVING count(*) > 1
            UNION ALL
            SELECT 'settlement', transaction_id, count(*) FROM settlement_all GROUP BY 2 HAVING count(*) > 1""",
        "repeated_ledger_ids": f"{relations()} SELECT 'T' || d AS transaction_id, CAST(2 AS BIGINT) AS rows FROM base WHERE c = 27",
        "deduplicated_feeds": _deduplicated(),
        "internal_without_gateway": f"""{relations()} SELECT transaction_id, CAST(gross_amount AS DOUBLE) AS gross_amount
            FROM internal_all WHERE transaction_id NOT IN (SELECT transaction_id FROM gateway_all)""",
        "gateway_without_internal": f"""{legacy} SELECT transaction_id, CAST(gateway_amount AS DOUBLE) AS gateway_amount
            FROM ug WHERE transaction_id NOT IN (SELECT transaction_id FROM internal_all)""",
        "settlement_without_internal": f"""{legacy} SELECT transaction_id, CAST(net_amount AS DOUBLE) AS net_amount
            FROM us WHERE transaction_id NOT IN (SELECT transaction_id FROM internal_all)""",
        "eligible_without_settlement": f"""{legacy} SELECT transaction_id, CAST(gateway_net AS DOUBLE) AS gateway_net
            FROM pairs WHERE internal_status = 'success' AND gateway_status = 'success'
              AND transaction_id NOT IN (SELECT transaction_id FROM settlement_all)""",
        "matched_ledger_gateway": f"""{legacy}
            SELECT transaction_id, internal_status, gateway_status,
                   {shown("m:gross_amount m:gateway_amount m:gateway_net")},
                   CAST(abs(gross_amount - gateway_amount) AS DOUBLE) AS gross_difference FROM pairs""",
        "matched_gateway_settlement": f"""{legacy}
            SELECT transaction_id, gateway_status, {shown("t:gateway_event_at t:settled_at")},
                   CAST(abs(gateway_fee - fee_amount) + abs(gateway_tax - tax_amount) AS DOUBLE) AS fee_tax_difference
            FROM ug JOIN us USING (transaction_id)""",
        "legacy_detections": f"{legacy} SELECT {shown(SIGNAL_COLUMNS)} FROM legacy",
        "legacy_vs_current": f"""{legacy},
            old_side AS (SELECT {compared} FROM legacy),
            new_side AS (SELECT {compared} FROM detected WHERE exception_type IN ({CORE}))
            SELECT * REPLACE (CAST(amount_at_risk AS DOUBLE) AS amount_at_risk), 'legacy' AS only_in
              FROM (FROM old_side EXCEPT FROM new_side)
            UNION ALL SELECT * REPLACE (CAST(amount_at_risk AS DOUBLE) AS amount_at_risk), 'current'
              FROM (FROM new_side EXCEPT FROM old_side)""",
        "truth_labels": _select("transaction_id exception_type m:reference_amount", "truth"),
        "evaluation_comparison": f"""{evaluated} SELECT exception_type, transaction_id, truth_present, detected_present,
            outcome, {shown("m:reference_amount m:amount_at_risk")} FROM compared""",
        "evaluation_by_type": f"""{evaluated} SELECT exception_type, tp, fp, fn, {_SCORES}
            FROM (SELECT exception_type, {_OUTCOMES} FROM compared GROUP BY 1)""",
        "evaluation_summary": f"""{evaluated} SELECT (SELECT count(*) FROM truth) AS truth_exceptions,
            (SELECT count(*) FROM found) AS detected_exceptions, tp, fp, fn, {_SCORES},
            CAST(injected AS DOUBLE) AS injected_reference_amount, CAST(captured AS DOUBLE) AS captured_reference_amount,
            round(CAST(captured AS DOUBLE) / CAST(injected AS DOUBLE), 6) AS amount_capture_rate
            FROM (SELECT {_OUTCOMES}, sum(reference_amount) AS injected,
                         sum(reference_amount) FILTER (WHERE outcome = 'tp') AS captured FROM compared)""",
        "snapshot_comparison": _snapshots(("1990-01-01 00:00:00", "1998-07-01 00:00:00", "2001-07-30 00:00:00")),
        "quarterly_snapshots": _snapshots(_quarter_ends()),
        "expected_fees": _expected_fees(),
        "fee_variance": _fee_variance(),
        "report_cards": _report_cards(),
        "exception_rate_text": f"{relations()} SELECT printf('%.2f%%', exception_transaction_rate * 100) AS exception_rate "
        "FROM totals",
        "operational_run": _report_rows(),
    }
    # What a file holds is what the table holds.
    of_table = {
        "queue_file": "investigation_queue",
        "summary_file": "summary",
        "evaluation_file": "evaluation_comparison",
        "manifest_file": "operational_run",
    }
    # Nor does the way a feed is stored change what its joins find.
    shapes = (
        "internal_without_gateway gateway_without_internal settlement_without_internal eligible_without_settlement "
        "matched_ledger_gateway matched_gateway_settlement"
    ).split()
    of_table |= {f"bucketed_{name}": name for name in shapes} | {"bucketed_facts": "payment_facts"}
    return found | {name: found[table] for name, table in of_table.items()}
