"""Independent DuckDB SQL for every registered batch query.

Money is rendered from integer cents (``money_text``) and averages are
rounded half-up from exact integers, which is what the JVM formatter gives
for these values; DuckDB's own ``printf('%.2f')`` rounds the binary value.
"""

from __future__ import annotations

from cardstream.schema import (
    DEFAULT_BLACKLISTED_COUNTRIES, DEFAULT_RISKY_MERCHANTS, TX_FIELDS,
)

TX_CTE = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         user_id * 2 + event_id % 2 AS cardno
  FROM events),
tx0 AS (
  SELECT event_id AS arrival_seq,
    'tx-' || CAST(100000 + event_id AS VARCHAR) AS transaction_id,
    'card-' || CAST(cardno AS VARCHAR) AS card_id,
    'cust-' || CAST(user_id AS VARCHAR) AS customer_id,
    'm-' || CAST(k % 30 AS VARCHAR) AS merchant_id,
    (['groceries','fuel','restaurants','electronics','travel'])[1 + (k % 30) % 5]
      AS merchant_category,
    (['IL','US','FR','DE','UK','IT','ES','NL'])[1 + (cardno + CASE WHEN
      event_type = 'error' AND k < 10 THEN 1 ELSE 0 END) % 8] AS country,
    CAST(1704067200000 + (epoch_us(ts) - 1704067200000000) // 720000
      - CASE WHEN event_id % 97 = 96 THEN 45000 + (event_id * 7919) % 75000
        ELSE 0 END AS BIGINT) AS event_time,
    round(value * 10, 2) AS amount
  FROM ev),
tx AS (SELECT *, CAST(round(amount * 100) AS BIGINT) AS amount_cents FROM tx0)"""

TX_COLS = ("arrival_seq, transaction_id, card_id, customer_id, merchant_id, "
           "merchant_category, country, event_time, amount, amount_cents")


def money_text(cents: str) -> str:
    return (f"(CAST(({cents}) // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))")


def avg_cents_rounded(sum_cents: str, n: str) -> str:
    return f"((2 * ({sum_cents}) + ({n})) // (2 * ({n})))"


def wend(ms: int) -> str:
    return f"(event_time - event_time % {ms} + {ms})"


def late_ctes(name: str, window_ms: int, lateness_ms: int, by: str = "") -> str:
    """CTE ``name`` = on-time rows of ``tx``; ``name``_late = late rows. ``by``: a PARTITION BY."""
    return f"""
{name}_wm AS (
  SELECT *, max(event_time) OVER ({by} ORDER BY arrival_seq ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS wm_before FROM tx),
{name} AS (SELECT * FROM {name}_wm WHERE NOT coalesce(
  {wend(window_ms)} + {lateness_ms} <= wm_before, false)),
{name}_late AS (SELECT * FROM {name}_wm WHERE coalesce(
  {wend(window_ms)} + {lateness_ms} <= wm_before, false))"""


def tx_json_sql(p: str = "") -> str:
    return (f"""'{{"transaction_id":"' || {p}transaction_id || '","card_id":"' || {p}card_id
  || '","customer_id":"' || {p}customer_id || '","merchant_id":"' || {p}merchant_id
  || '","merchant_category":"' || {p}merchant_category || '","country":"' || {p}country
  || '","event_time":' || CAST({p}event_time AS VARCHAR) || ',"amount":'
  || {money_text(p + 'amount_cents')} || '}}'""")


TX_FLAT = ", ".join(f"t_{c} AS tx_{c}" for c in TX_FIELDS)


def _null(t: str) -> str:
    return f"CAST(NULL AS {t})"


def window_rule_sql(src: str, key: str, entity: str, rule: str, threshold: int,
                    suffix: str) -> str:
    args = ", ".join(f"arg_max({c}, arrival_seq) AS t_{c}" for c in TX_FIELDS)
    return f"""
  SELECT t_event_time AS timestamp, '{entity}' AS entity_type, entity_id,
    '{rule}' AS rule,
    'Transactions in 2 minutes: ' || CAST(n AS VARCHAR) || '{suffix}' AS decision_values,
    n AS n_in_window, {_null('BIGINT')} AS hist_n, {_null('DOUBLE')} AS hist_avg,
    {_null('VARCHAR')} AS prev_country, {_null('BIGINT')} AS gap_minutes, {TX_FLAT}
  FROM (SELECT {key} AS entity_id, {wend(120000)} AS wend, count(*) AS n, {args}
        FROM {src} GROUP BY 1, 2 HAVING count(*) > {threshold})"""


def high_amount_sql() -> str:
    tflat = ", ".join(f"{c} AS tx_{c}" for c in TX_FIELDS)
    avg_txt = money_text(avg_cents_rounded("hist_sum", "hist_n"))
    return f"""
  SELECT event_time AS timestamp, 'Customer' AS entity_type, customer_id AS entity_id,
    'High Amount' AS rule,
    'Amount: ' || {money_text('amount_cents')} || ', Historical Avg: ' || {avg_txt}
      AS decision_values,
    {_null('BIGINT')} AS n_in_window, hist_n,
    CAST(hist_sum AS DOUBLE) / CAST(hist_n * 100 AS DOUBLE) AS hist_avg,
    {_null('VARCHAR')} AS prev_country, {_null('BIGINT')} AS gap_minutes, {tflat}
  FROM (SELECT *, count(amount_cents) OVER w AS hist_n,
               CAST(sum(amount_cents) OVER w AS BIGINT) AS hist_sum
        FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY arrival_seq
                             ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
  WHERE hist_n >= 5
    AND CAST(amount_cents * hist_n AS DOUBLE) >= 3.0 * CAST(hist_sum AS DOUBLE)
    AND amount_cents > 50000"""


def travel_sql() -> str:
    tflat = ", ".join(f"{c} AS tx_{c}" for c in TX_FIELDS)
    return f"""
  SELECT event_time AS timestamp, 'Card' AS entity_type, card_id AS entity_id,
    'Impossible Travel' AS rule,
    'Previous Country: ' || prev_country || ', Current Country: ' || country
      || ', Time Gap Minutes: ' || CAST((event_time - prev_et) // 60000 AS VARCHAR)
      AS decision_values,
    {_null('BIGINT')} AS n_in_window, {_null('BIGINT')} AS hist_n,
    {_null('DOUBLE')} AS hist_avg, prev_country,
    (event_time - prev_et) // 60000 AS gap_minutes, {tflat}
  FROM (SELECT *, lag(country) OVER w AS prev_country, lag(event_time) OVER w AS prev_et,
               lag(1) OVER w AS has_prev
        FROM tx WINDOW w AS (PARTITION BY card_id ORDER BY arrival_seq))
  WHERE has_prev IS NOT NULL AND prev_country IS DISTINCT FROM country
    AND event_time - prev_et < 1800000"""


HF = window_rule_sql("tx", "card_id", "Card", "High Frequency", 5, "")
MB = window_rule_sql("tx", "merchant_id", "Merchant", "Merchant Burst", 20,
                     " (normal load ~9)")
ALL_ALERTS = f"{HF}\n  UNION ALL {high_amount_sql()}\n  UNION ALL {travel_sql()}\n  UNION ALL {MB}"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def scored_ctes(all_alerts: str) -> str:
    return f"""
scored AS (
  SELECT *, CAST(least(100, CASE rule WHEN 'Impossible Travel' THEN 60
      WHEN 'High Amount' THEN 50 WHEN 'High Frequency' THEN 40
      WHEN 'Merchant Burst' THEN 30 ELSE 20 END
    + CASE WHEN tx_transaction_id IS NULL THEN 0 ELSE
        (CASE WHEN tx_merchant_id IN ({_in_list(DEFAULT_RISKY_MERCHANTS)}) THEN 20 ELSE 0 END)
      + (CASE WHEN tx_country IN ({_in_list(DEFAULT_BLACKLISTED_COUNTRIES)}) THEN 25 ELSE 0 END)
      + (CASE WHEN tx_amount > 1000 THEN 10 ELSE 0 END) END) AS INTEGER) AS risk_score
  FROM ({all_alerts})),
scored_l AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM'
    ELSE 'LOW' END AS risk_level FROM scored)"""


SCORED = scored_ctes(ALL_ALERTS)
ALL_ALERTS_ONTIME = (
    window_rule_sql("ot2", "card_id", "Card", "High Frequency", 5, "")
    + f"\n  UNION ALL {high_amount_sql()}\n  UNION ALL {travel_sql()}\n  UNION ALL "
    + window_rule_sql("ot2", "merchant_id", "Merchant", "Merchant Burst", 20,
                      " (normal load ~9)"))


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([TX_CTE, *ctes]) + "\n"


def minute_sql(src: str) -> str:
    return f"""SELECT {wend(60000)} AS window_end, count(*) AS n_tx,
  CAST(sum(amount_cents) AS BIGINT) AS total_cents,
  CAST(sum(amount_cents) AS DOUBLE) / 100.0 AS total_amount
FROM {src} GROUP BY 1"""


def category_sql(src: str) -> str:
    return f"""SELECT {wend(300000)} AS window_end, merchant_category, count(*) AS n_tx,
  CAST(sum(amount_cents) AS BIGINT) AS sum_cents,
  CAST(sum(amount_cents) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS avg_amount
FROM {src} GROUP BY 1, 2"""


def country_sql(src: str) -> str:
    return f"""SELECT {wend(300000)} AS window_end, country, count(*) AS n_tx
FROM {src} GROUP BY 1, 2"""


METRIC_LINES = f"""
SELECT 'minute_totals' AS metric, window_end, CAST(NULL AS VARCHAR) AS key,
  'Timestamp: ' || CAST(window_end AS VARCHAR) || ', Total Transactions: '
  || CAST(n_tx AS VARCHAR) || ', Total Amount: ' || {money_text('total_cents')} AS line
FROM ({minute_sql('tx')})
UNION ALL
SELECT 'category_average', window_end, merchant_category,
  'Timestamp: ' || CAST(window_end AS VARCHAR) || ', Category: ' || merchant_category
  || ', Average Amount: ' || {money_text(avg_cents_rounded('sum_cents', 'n_tx'))}
FROM ({category_sql('tx')})
UNION ALL
SELECT 'country_counts', window_end, country,
  'Timestamp: ' || CAST(window_end AS VARCHAR) || ', Country: ' || country
  || ', Transactions: ' || CAST(n_tx AS VARCHAR)
FROM ({country_sql('tx')})"""

ALERT_LINE = f"""'Anomaly Detected! Timestamp: ' || CAST(timestamp AS VARCHAR) || ', '
  || entity_type || ': ' || entity_id || ', Rule: ' || rule || ', ' || decision_values
  || ' | Risk Score: ' || CAST(risk_score AS VARCHAR) || '/100 (' || risk_level || ')'
  || ' | Suspicious Tx: ' || tx_transaction_id || ', merchant ' || tx_merchant_id
  || ' (' || tx_merchant_category || '), country ' || tx_country || ', amount '
  || {money_text('CAST(round(tx_amount * 100) AS BIGINT)')}"""

ONTIME_1M = late_ctes("ot1", 60000, 10000)
ONTIME_5M = late_ctes("ot5", 300000, 0)
ONTIME_2M = late_ctes("ot2", 120000, 0)

MINUTE_EMISSIONS = f"""
r AS (SELECT *, {wend(60000)} AS window_end,
        (wm_before IS NULL OR wm_before < {wend(60000)}) AS pre FROM ot1),
base AS (SELECT window_end, count(*) FILTER (WHERE pre) AS n_pre,
        coalesce(CAST(sum(amount_cents) FILTER (WHERE pre) AS BIGINT), 0) AS c_pre,
        max(event_time) AS wmax
      FROM r GROUP BY window_end),
g AS (SELECT max(wmax) AS gmax FROM base),
em AS (
  SELECT window_end, CAST(0 AS BIGINT) AS emission,
    CASE WHEN window_end + 5000 <= gmax THEN 'watermark' ELSE 'end_of_input' END AS fired_by,
    n_pre AS n_tx, c_pre AS total_cents
  FROM base, g WHERE n_pre > 0
  UNION ALL
  SELECT r.window_end, row_number() OVER w, 'late_row', b.n_pre + count(*) OVER w,
    b.c_pre + CAST(sum(r.amount_cents) OVER w AS BIGINT)
  FROM r JOIN base b USING (window_end) WHERE NOT r.pre
  WINDOW w AS (PARTITION BY r.window_end ORDER BY r.arrival_seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

BATCH_SQL: dict[str, str] = {
    "transactions": _with() + f"SELECT {TX_COLS} FROM tx",
    "transaction_json_lines": _with() + f"SELECT arrival_seq, {tx_json_sql()} AS line FROM tx",
    "parse_roundtrip": _with() + (
        "SELECT transaction_id, card_id, customer_id, merchant_id, merchant_category, "
        "country, event_time, amount, amount_cents FROM tx"),
    "rejects": _with() + (
        f"SELECT substr(line, 1, length(line) // 2) AS line, 'malformed_json' AS reason "
        f"FROM (SELECT arrival_seq, {tx_json_sql()} AS line FROM tx) "
        f"WHERE arrival_seq % 50 = 0"),
    "reject_classes": _with() + (
        "SELECT arrival_seq, CASE WHEN arrival_seq % 12 <= 6 THEN 'reject' ELSE 'tx' END AS kind, "
        "CASE arrival_seq % 12 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'bad_value' "
        "WHEN 2 THEN 'out_of_range' WHEN 3 THEN 'out_of_range' WHEN 4 THEN 'out_of_range' "
        "WHEN 5 THEN 'missing_key' WHEN 6 THEN 'bad_value' END AS reason "
        "FROM tx WHERE arrival_seq % 12 NOT IN (7, 8)"),
    "reference_list": _with() + "SELECT DISTINCT merchant_id AS value FROM tx",
    "minute_totals": _with() + minute_sql("tx"),
    "minute_totals_ontime": _with(ONTIME_1M) + minute_sql("ot1"),
    "minute_total_emissions": _with(ONTIME_1M, MINUTE_EMISSIONS) + (
        "SELECT *, CAST(total_cents AS DOUBLE) / 100.0 AS total_amount, "
        "'Timestamp: ' || CAST(window_end AS VARCHAR) || ', Total Transactions: ' || "
        f"CAST(n_tx AS VARCHAR) || ', Total Amount: ' || {money_text('total_cents')} "
        "AS line FROM em"),
    "late_transactions": _with(ONTIME_1M) + (
        f"SELECT {TX_COLS}, {tx_json_sql()} AS line FROM ot1_late"),
    "category_average": _with() + category_sql("tx"),
    "category_average_ontime": _with(ONTIME_5M) + category_sql("ot5"),
    "country_counts": _with() + country_sql("tx"),
    "country_counts_ontime": _with(ONTIME_5M) + country_sql("ot5"),
    "metric_lines": _with() + METRIC_LINES,
    "high_frequency_alerts": _with() + HF,
    "high_frequency_alerts_ontime": _with(ONTIME_2M) + window_rule_sql(
        "ot2", "card_id", "Card", "High Frequency", 5, ""),
    "high_amount_alerts": _with() + high_amount_sql(),
    "impossible_travel_alerts": _with() + travel_sql(),
    "merchant_burst_alerts": _with() + MB,
    "merchant_burst_alerts_ontime": _with(ONTIME_2M) + window_rule_sql(
        "ot2", "merchant_id", "Merchant", "Merchant Burst", 20, " (normal load ~9)"),
    "all_alerts": _with() + ALL_ALERTS,
    "scored_alerts": _with(SCORED) + "SELECT * FROM scored_l",
    "scored_alerts_ontime": _with(late_ctes("ot2", 120000, 0), scored_ctes(
        ALL_ALERTS_ONTIME)) + "SELECT * FROM scored_l",
    "alert_lines": _with(SCORED) + (
        f"SELECT rule, entity_id, timestamp, tx_transaction_id, {ALERT_LINE} AS line "
        f"FROM scored_l"),
}
# A source of four partitions, dealt by the card's number: late by the own partition's rows.
OWN_1M = late_ctes("op1", 60000, 10000, "PARTITION BY CAST(substr(card_id, 6) AS BIGINT) % 4")
BATCH_SQL["late_transactions_partitioned"] = _with(OWN_1M) + f"SELECT {TX_COLS}, {tx_json_sql()} AS line FROM op1_late"
PARTITIONED_MINUTE_SQL = _with(OWN_1M) + minute_sql("op1")

BATCH_SQL["job_scored_alerts"] = BATCH_SQL["scored_alerts_ontime"]
BATCH_SQL["job_late_transactions"] = BATCH_SQL["late_transactions"]
for _name in ("minute_totals", "category_average", "country_counts"):
    BATCH_SQL[f"job_{_name}"] = BATCH_SQL[f"{_name}_ontime"]

# --- amounts of more than two decimals ---------------------------------------------
# Sums are of whole cents and of what amounts have beyond them, in 1e-7 cents.
SUBCENT_TX = TX_CTE.replace("round(value * 10, 2) AS amount", "value * 100 / 7 AS amount").replace(
    "\ntx AS (SELECT *,", "\ntx1 AS (SELECT *,").replace("FROM tx0)", """FROM tx0),
tx AS (SELECT *, CAST(floor((amount - CAST(amount_cents AS DOUBLE) / 100) * 1e9 + 0.5) AS BIGINT) AS rest
       FROM tx1)""")


def _exact(cents: str, rest: str) -> str:
    return f"(CAST({cents} AS DOUBLE) + CAST({rest} AS DOUBLE) / 1e7)"


def _whole(cents: str, rest: str) -> str:
    return f"CAST({cents} + floor(CAST({rest} AS DOUBLE) / 1e7 + 0.5) AS BIGINT)"


def _double_text(x: str) -> str:
    return money_text(f"CAST(round(({x}) * 100) AS BIGINT)")


_C, _R = "sum(amount_cents)", "sum(rest)"
_WITH_SUBCENT = f"WITH {SUBCENT_TX}"
BATCH_SQL["minute_totals_subcent"] = f"""{_WITH_SUBCENT}
SELECT {wend(60000)} AS window_end, count(*) AS n_tx, {_whole(_C, _R)} AS total_cents,
  {_exact(_C, _R)} / 100 AS total_amount
FROM tx GROUP BY 1"""
BATCH_SQL["category_average_subcent"] = f"""{_WITH_SUBCENT}
SELECT {wend(300000)} AS window_end, merchant_category, count(*) AS n_tx,
  {_whole(_C, _R)} AS sum_cents, {_exact(_C, _R)} / CAST(count(*) * 100 AS DOUBLE) AS avg_amount
FROM tx GROUP BY 1, 2"""
BATCH_SQL["high_amount_alerts_subcent"] = f"""{_WITH_SUBCENT},
h AS (SELECT *, count(*) OVER w AS hist_n, {_exact("sum(amount_cents) OVER w", "sum(rest) OVER w")} AS hist
      FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY arrival_seq
                           ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, hist / CAST(hist_n * 100 AS DOUBLE) AS hist_avg FROM h
      WHERE hist_n >= 5 AND amount > 500
        AND {_exact("(amount_cents * hist_n)", "(rest * hist_n)")} >= 3 * hist)
SELECT event_time AS timestamp, 'Customer' AS entity_type, customer_id AS entity_id,
  'High Amount' AS rule,
  'Amount: ' || {_double_text("amount")} || ', Historical Avg: ' || {_double_text("hist_avg")}
    AS decision_values,
  {_null("BIGINT")} AS n_in_window, hist_n, hist_avg, {_null("VARCHAR")} AS prev_country,
  {_null("BIGINT")} AS gap_minutes, {", ".join(f"{c} AS tx_{c}" for c in TX_FIELDS)}
FROM a"""
BATCH_SQL["minute_total_emissions_subcent"] = f"""{_WITH_SUBCENT}, {ONTIME_1M},
r AS (SELECT *, {wend(60000)} AS window_end,
        (wm_before IS NULL OR wm_before < {wend(60000)}) AS pre FROM ot1),
g AS (SELECT max(event_time) AS gmax FROM r),
run AS (SELECT *, count(*) OVER w AS n, sum(amount_cents) OVER w AS c, sum(rest) OVER w AS q,
          count(*) FILTER (WHERE NOT pre) OVER w AS again,
          row_number() OVER (PARTITION BY window_end, pre ORDER BY arrival_seq DESC) AS from_end
        FROM r WINDOW w AS (PARTITION BY window_end ORDER BY pre DESC, arrival_seq
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
em AS (SELECT window_end, CAST(again AS BIGINT) AS emission,
         CASE WHEN NOT pre THEN 'late_row' WHEN window_end + 5000 <= gmax THEN 'watermark'
              ELSE 'end_of_input' END AS fired_by,
         n AS n_tx, {_whole("c", "q")} AS total_cents, {_exact("c", "q")} / 100 AS total_amount
       FROM run, g WHERE NOT pre OR from_end = 1)
SELECT *, 'Timestamp: ' || CAST(window_end AS VARCHAR) || ', Total Transactions: '
  || CAST(n_tx AS VARCHAR) || ', Total Amount: ' || {_double_text("total_amount")} AS line
FROM em"""
