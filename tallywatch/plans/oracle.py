"""The registered queries again, as SQL over the provided tables.

Each statement is put together from named common table expressions. They say
what a query must return, in plain SQL, and share nothing with the Spark code.
"""

from __future__ import annotations


def _r(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


_COLUMNS = (
    "transaction_id, event_ts, customer_id, merchant_id, merchant_category, amount, currency, "
    "country, device_id, channel, is_fraud, fraud_type"
)

_RAW = """
raw AS (
  SELECT e.event_id, c.copy_no, e.day AS feed_date,
    CASE WHEN event_id % 419 <> 6 THEN CAST(event_id AS VARCHAR) END AS transaction_id,
    CASE WHEN event_id % 401 <> 4 THEN ts END AS event_ts,
    CASE WHEN event_id % 409 <> 5 THEN 'C' || user_id END AS customer_id,
    CASE WHEN event_id % 251 <> 1 THEN 'M' || k END AS merchant_id,
    CASE WHEN event_id % 251 <> 1 THEN 'cat' || (k % 10) END AS merchant_category,
    CASE WHEN event_id % 337 = 3 THEN NULL WHEN event_id % 331 = 2 THEN -value ELSE value END AS amount,
    CASE WHEN event_id % 89 = 7 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN event_id % 17 = 0 THEN 'F' || (user_id % 6) ELSE 'H' || (user_id % 8) END AS country,
    'D' || user_id || '_' || (event_id % 3) AS device_id,
    CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'online' ELSE 'pos' END AS channel,
    CAST(event_type = 'error' AND value >= 150 AS INTEGER) AS is_fraud,
    CASE WHEN event_type = 'error' AND value >= 150 THEN
      CASE k % 3 WHEN 0 THEN 'card_testing' WHEN 1 THEN 'account_takeover' ELSE 'merchant_collusion' END
    END AS fraud_type
  FROM (SELECT *, CAST(ts AS DATE) AS day, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
        FROM events) e
  JOIN (SELECT 1 AS copy_no UNION ALL SELECT 2) c ON c.copy_no = 1 OR e.event_id % 211 = 0
)"""
_CHECKED = """
checked AS (
  SELECT *, transaction_id IS NOT NULL AS ok_id, event_ts IS NOT NULL AS ok_ts,
    customer_id IS NOT NULL AS ok_customer, amount IS NOT NULL AND amount > 0 AS ok_amount
  FROM raw
)"""
_SILVER = """
silver AS (
  SELECT * FROM checked WHERE ok_id AND ok_ts AND ok_customer AND ok_amount
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY copy_no) = 1
)"""
_REJECTED = """
rejected AS (
  SELECT *, concat_ws(', ',
      CASE WHEN NOT ok_id THEN 'valid_transaction_id' END,
      CASE WHEN NOT ok_ts THEN 'valid_event_ts' END,
      CASE WHEN NOT ok_customer THEN 'valid_customer' END,
      CASE WHEN NOT ok_amount THEN 'valid_amount' END) AS _quarantine_reason
  FROM checked WHERE NOT (ok_id AND ok_ts AND ok_customer AND ok_amount)
)"""
_ORDERS = """
purchases AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_orderdate AS TIMESTAMP) AS event_ts,
    'C' || o_custkey AS customer_id, 'M' || l_suppkey AS merchant_id,
    'cat' || (l_suppkey % 10) AS merchant_category, l_extendedprice AS amount, 'USD' AS currency,
    'H' || (l_partkey % 7) AS country, 'D' || (l_partkey % 5) AS device_id,
    CASE WHEN l_linestatus = 'O' THEN 'online' ELSE 'pos' END AS channel,
    CAST(l_returnflag = 'R' AS INTEGER) AS is_fraud,
    CASE WHEN l_returnflag = 'R' THEN 'returned' END AS fraud_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_extendedprice, l_quantity, l_partkey, 'M' || l_suppkey) = 1
)"""


def _daily(source: str) -> str:
    return f"""
daily AS (
  SELECT CAST(event_ts AS DATE) AS txn_date, count(*) AS txn_count, {_r('sum(amount)', 2)} AS total_amount,
    {_big('sum(is_fraud)')} AS fraud_count,
    {_r('sum(CASE WHEN is_fraud = 1 THEN amount ELSE 0 END)', 2)} AS fraud_amount,
    {_r('avg(is_fraud) * 100', 4)} AS fraud_rate_pct, count(DISTINCT customer_id) AS active_customers
  FROM {source} GROUP BY 1
)"""


def _merchants(source: str) -> str:
    return f"""
merchants AS (
  SELECT merchant_id, merchant_category, count(*) AS txn_count, {_r('avg(amount)', 2)} AS avg_amount,
    {_big('sum(is_fraud)')} AS fraud_count, {_r('avg(is_fraud) * 100', 4)} AS fraud_rate_pct
  FROM {source} GROUP BY 1, 2
)"""


def _profiles(source: str) -> str:
    return f"""
profiles AS (
  SELECT customer_id, count(*) AS txn_count, {_r('avg(amount)', 2)} AS avg_amount,
    {_r('stddev_samp(amount)', 2)} AS std_amount, count(DISTINCT country) AS distinct_countries,
    count(DISTINCT device_id) AS distinct_devices,
    {_r('avg(CASE WHEN hour(event_ts) < 6 THEN 1 ELSE 0 END)', 4)} AS night_txn_ratio,
    max(event_ts) AS last_seen_ts
  FROM {source} GROUP BY 1
)"""


_BOUND = """
bound AS (SELECT CAST(min(CAST(event_ts AS DATE)) + 24 AS DATE) AS split_date FROM silver)"""


def _risk(source: str, condition: str = "TRUE") -> str:
    return f"""
risk AS (
  SELECT merchant_id, (sum(is_fraud) + 1) / CAST(count(*) + 200 AS DOUBLE) AS merchant_fraud_rate
  FROM {source} WHERE {condition} GROUP BY 1
)"""


_TRAIN_RISK = _risk("silver", "CAST(event_ts AS DATE) <= (SELECT split_date FROM bound)")


def _features(source: str) -> str:
    return f"""
ordered AS (
  SELECT *, epoch_us(event_ts) // 1000000 AS sec, substr(md5(transaction_id), 1, 15) AS tie FROM {source}
),
feat AS (
  SELECT o.transaction_id, o.event_ts, o.customer_id, o.amount, ln(1 + o.amount) AS log_amount,
    CAST(hour(o.event_ts) AS INTEGER) AS hour, CAST(hour(o.event_ts) < 6 AS INTEGER) AS is_night,
    CAST(o.channel = 'online' AS INTEGER) AS is_online,
    CAST(o.country <> first_value(o.country) OVER (PARTITION BY o.customer_id ORDER BY sec, tie
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS is_foreign,
    CAST(row_number() OVER (PARTITION BY o.customer_id, o.device_id ORDER BY sec, tie) = 1 AS INTEGER)
      AS is_new_device,
    count(*) OVER (PARTITION BY o.customer_id ORDER BY sec
      RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING) AS txn_count_1h,
    count(*) OVER (PARTITION BY o.customer_id ORDER BY sec
      RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS txn_count_24h,
    coalesce(o.amount / avg(o.amount) OVER (PARTITION BY o.customer_id ORDER BY sec, tie
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS amount_over_avg,
    coalesce(sec - lag(sec) OVER (PARTITION BY o.customer_id ORDER BY sec, tie), 2592000)
      AS seconds_since_prev_txn,
    coalesce(r.merchant_fraud_rate, 0.0) AS merchant_fraud_rate
  FROM ordered o LEFT JOIN risk r ON o.merchant_id = r.merchant_id
)"""


_SHOWN = f"""
SELECT transaction_id, amount, {_r('log_amount', 6)} AS log_amount, hour, is_night, is_online, is_foreign,
  is_new_device, txn_count_1h, txn_count_24h, {_r('amount_over_avg', 6)} AS amount_over_avg,
  seconds_since_prev_txn, {_r('merchant_fraud_rate', 6)} AS merchant_fraud_rate
FROM feat"""


def _score(multiplier: int) -> str:
    return f"CAST((CAST(transaction_id AS BIGINT) * {multiplier}) % 1001 AS DOUBLE) / 1000"


_CARDS = f"""
cards AS (
  SELECT 'card_a' AS model, transaction_id, event_ts, is_fraud, {_score(7919)} AS fraud_score FROM silver
  UNION ALL
  SELECT 'card_b', transaction_id, event_ts, is_fraud, {_score(3967)} FROM silver
  UNION ALL
  SELECT 'incumbent', transaction_id, event_ts, is_fraud, {_score(6007)} FROM silver
)"""
_CURVE = """
per_score AS (
  SELECT model, fraud_score, CAST(sum(is_fraud) AS BIGINT) AS pos, CAST(sum(1 - is_fraud) AS BIGINT) AS neg
  FROM cards GROUP BY 1, 2
),
curve AS (
  SELECT *, CAST(sum(pos) OVER falling AS BIGINT) AS tp, CAST(sum(neg) OVER falling AS BIGINT) AS fp,
    CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS positives,
    CAST(sum(neg) OVER (PARTITION BY model) AS BIGINT) AS negatives
  FROM per_score WINDOW falling AS (PARTITION BY model ORDER BY fraud_score DESC)
)"""
_PR_AUC = """
areas AS (
  SELECT model, sum(pos / CAST(positives AS DOUBLE) * tp / (tp + fp)) AS pr_auc FROM curve GROUP BY 1
)"""
# Area by its definition: pairs of one positive and one negative, ties counted half.
_ROC_AUC = f"""
SELECT p.model, {_r('sum(p.pos * n.neg * CASE WHEN p.fraud_score > n.fraud_score THEN 1.0 '
                    'WHEN p.fraud_score = n.fraud_score THEN 0.5 ELSE 0.0 END)'
                    ' / (CAST(sum(p.pos * n.neg) AS DOUBLE))', 6)} AS roc_auc
FROM per_score p JOIN per_score n ON p.model = n.model GROUP BY 1"""
_RECALL = f"""
SELECT model, {_r('coalesce(max(CASE WHEN fp / CAST(negatives AS DOUBLE) <= 0.005 '
                  'THEN tp / CAST(positives AS DOUBLE) END), 0.0)', 6)} AS recall_at_fpr
FROM curve GROUP BY 1"""


def _precision(groups: str, k: int) -> str:
    return f"""
SELECT {groups}, {_r('avg(is_fraud)', 6)} AS precision_at_k FROM (
  SELECT *, CAST(event_ts AS DATE) AS score_date FROM cards
  QUALIFY row_number() OVER (PARTITION BY {groups.replace('score_date', 'CAST(event_ts AS DATE)')}
    ORDER BY fraud_score DESC, transaction_id) <= {k}
) GROUP BY {groups}"""


_GATE = f"""
SELECT c.model AS challenger, {_r('c.pr_auc', 6)} AS challenger_pr_auc, {_r('i.pr_auc', 6)} AS incumbent_pr_auc,
  CAST(c.pr_auc >= i.pr_auc AS INTEGER) AS promoted
FROM (SELECT * FROM areas WHERE model <> 'incumbent' ORDER BY pr_auc DESC, model LIMIT 1) c,
  (SELECT * FROM areas WHERE model = 'incumbent') i"""


def _alerted(name: str, source: str, score: str, version: int, budget: int = 200) -> str:
    """Predictions of every date of ``source``: score, rank in the day, alert flag."""
    return f"""
{name} AS (
  SELECT transaction_id, event_ts, customer_id, amount, fraud_score,
    CAST(fraud_score >= 0.5 AND row_number() OVER (PARTITION BY CAST(event_ts AS DATE)
      ORDER BY fraud_score DESC, transaction_id) <= {budget} AS INTEGER) AS is_alert,
    {version} AS model_version, TIMESTAMP '2024-02-02 00:00:00' AS scored_at
  FROM (SELECT *, {score} AS fraud_score FROM {source})
)"""


_POINTS = f"""(coalesce(is_foreign, 0) * 200 + is_new_device * 150 + is_night * 100
      + least(txn_count_1h, 2) * 60 + least(txn_count_24h, 5) * 40
      + CASE WHEN {_r('amount_over_avg', 6)} > 2 THEN 200 ELSE 0 END
      + CASE WHEN amount > 100 THEN 100 ELSE 0 END
      + CASE WHEN seconds_since_prev_txn < 7200 THEN 50 ELSE 0 END) / CAST(1000 AS DOUBLE)"""
_LATEST = "CAST(event_ts AS DATE) = (SELECT max(CAST(event_ts AS DATE)) FROM silver)"


def _lookback(last: str) -> str:
    return f"""
recent AS (
  SELECT * FROM silver
  WHERE CAST(event_ts AS DATE) <= {last} AND CAST(event_ts AS DATE) > {last} - 30
)"""


_LAST_DATE = "(SELECT max(CAST(event_ts AS DATE)) FROM silver)"


def _batch(score: str, last: str) -> list[str]:
    return [_RAW, _CHECKED, _SILVER, _BOUND, _TRAIN_RISK, _lookback(last), _features("recent"),
            f"\nday AS (SELECT * FROM feat WHERE CAST(event_ts AS DATE) = {last})",
            _alerted("preds", "day", score, 1)]


_PREDS = _alerted("preds", "silver", _score(7919), 1)
_STORED = [
    _alerted("first_load", "(SELECT * FROM silver WHERE event_ts < DATE '2024-01-28')", _score(7919), 1),
    _alerted("second_load", "(SELECT * FROM silver WHERE event_ts >= DATE '2024-01-26')", _score(6007), 2),
]

# Edges are whole multiples of one tenth as a double, as the bins are defined.
_BASELINE = f"""
bins AS (
  SELECT b AS bin, b * CAST(0.1 AS DOUBLE) AS bin_low,
    CASE WHEN b = 9 THEN 1.0 ELSE (b + 1) * CAST(0.1 AS DOUBLE) END AS bin_high
  FROM (SELECT unnest(range(10)) AS b)
),
test_scores AS (
  SELECT {_score(7919)} AS fraud_score FROM silver
  WHERE CAST(event_ts AS DATE) > (SELECT split_date FROM bound)
),
baseline AS (
  SELECT bin, bin_low, bin_high,
    (SELECT count(*) FROM test_scores WHERE fraud_score >= bin_low
      AND (fraud_score < bin_high OR (bin = 9 AND fraud_score <= 1))) / CAST(greatest(
      (SELECT count(*) FROM test_scores), 1) AS DOUBLE) AS fraction
  FROM bins
)"""


def _drift(preds: str) -> str:
    return f"""
days AS (
  SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS monitor_date, max(model_version) AS model_version,
    count(*) AS total FROM {preds} GROUP BY 1
),
daily_bins AS (
  SELECT d.monitor_date, b.bin, b.fraction AS expected, count(p.fraud_score) / CAST(max(d.total) AS DOUBLE) AS actual
  FROM days d JOIN baseline b ON TRUE LEFT JOIN {preds} p
    ON CAST(CAST(p.event_ts AS DATE) AS VARCHAR) = d.monitor_date AND p.fraud_score >= b.bin_low
    AND (p.fraud_score < b.bin_high OR (b.bin = 9 AND p.fraud_score <= 1))
  GROUP BY 1, 2, 3
),
drift AS (
  SELECT monitor_date, sum((greatest(actual, 1e-4) - greatest(expected, 1e-4))
    * ln(greatest(actual, 1e-4) / greatest(expected, 1e-4))) AS psi
  FROM daily_bins GROUP BY 1
),
effect AS (
  SELECT CAST(CAST(p.event_ts AS DATE) AS VARCHAR) AS monitor_date, CAST(count(*) AS INTEGER) AS scored_count,
    CAST(sum(is_alert) AS INTEGER) AS alert_count, CAST(sum(is_fraud) AS INTEGER) AS actual_fraud_count,
    CAST(sum(is_alert * is_fraud) AS INTEGER) AS true_positive_count,
    {_r('sum(is_alert * is_fraud) / CAST(nullif(sum(is_alert), 0) AS DOUBLE)', 6)} AS alert_precision,
    {_r('sum(is_alert * is_fraud) / CAST(nullif(sum(is_fraud), 0) AS DOUBLE)', 6)} AS fraud_recall
  FROM {preds} p JOIN silver s ON p.transaction_id = s.transaction_id GROUP BY 1
)"""


_METRICS = f"""
SELECT d.monitor_date, model_version, {_r('psi', 6)} AS psi, scored_count, alert_count, actual_fraud_count,
  true_positive_count, alert_precision, fraud_recall, TIMESTAMP '2024-02-02 00:00:00' AS computed_at
FROM days d JOIN drift USING (monitor_date) JOIN effect USING (monitor_date)"""

_CLEAN = [_RAW, _CHECKED, _SILVER]
_BAD = [_RAW, _CHECKED, _REJECTED]
_MONITORED = [*_CLEAN, _BOUND, _PREDS, _BASELINE, _drift("preds")]


def _rule(name: str, severity: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS rule, '{severity}' AS severity, "
        f"count(*) FILTER (WHERE {condition}) AS passed_rows, "
        f"count(*) - count(*) FILTER (WHERE {condition}) AS failed_rows FROM checked"
    )


_RULES = "\nUNION ALL\n".join(
    [
        _rule("valid_transaction_id", "hard", "ok_id"),
        _rule("valid_event_ts", "hard", "ok_ts"),
        _rule("valid_customer", "hard", "ok_customer"),
        _rule("valid_amount", "hard", "ok_amount"),
        _rule("known_merchant", "soft", "merchant_id IS NOT NULL"),
        _rule("known_currency", "soft", "currency = 'USD'"),
    ]
)


def _sql(parts: list[str], final: str) -> str:
    return "WITH" + ",".join(parts) + "\n" + final.strip()


_UPSERT_MONITORING = f"""
SELECT * FROM ({_sql([_BASELINE, _drift('preds')], _METRICS)})
UNION ALL
SELECT * FROM ({_sql([_BASELINE, _drift('second_load')], _METRICS)})"""



def _field(name: str, contract: str, merged: str, texts: str = "0", numbers: str = "0", integers: str = "0", misfits: str = "0") -> str:
    return f"""SELECT '{name}' AS field, {contract} AS contract, '{merged}' AS merged, {_big(integers)} AS integers, {_big(numbers)} AS numbers,
      {_big(texts)} AS texts, {_big('0')} AS booleans, {_big('0')} AS nested, {_big('0')} AS nulls, {_big(misfits)} AS misfits FROM raw"""


# Names of the model inputs.
_TERMS = ("amount log_amount hour is_night is_online is_foreign is_new_device txn_count_1h txn_count_24h amount_over_avg "
          "seconds_since_prev_txn merchant_fraud_rate intercept").split()  # fmt: skip
_WORDS = "transaction_id customer_id merchant_id merchant_category currency country device_id channel fraud_type".split()
_AS_TEXT = "count(*) FILTER (event_id % 337 = 3 OR (event_id % 13 = 4 AND amount IS NOT NULL))"
_PROMO = "count(*) FILTER (event_id % 307 = 0)"
_FIELD_TYPES = " UNION ALL ".join(
    [_field(name, "'string'", "text", texts=f"count({name})") for name in _WORDS]
    + [
        _field("event_ts", "'timestamp'", "text", texts="count(event_ts)"),
        _field(
            "amount", "'double'", "text", texts=_AS_TEXT, misfits="count(*) FILTER (event_id % 337 = 3)",
            numbers="count(*) FILTER (event_id % 337 <> 3 AND event_id % 13 <> 4 AND amount IS NOT NULL)",
        ),
        _field("is_fraud", "'int'", "integer", integers="count(is_fraud)"),
        _field("promo_code", "NULL", "text", texts=_PROMO, misfits=_PROMO),
    ]
)

_SILVER_OUT = f"SELECT {_COLUMNS} FROM silver"

ORACLE: dict[str, str] = {
    "bronze_ingest": _sql([_RAW], f"SELECT {_COLUMNS} FROM raw"),
    "bronze_batch": _sql([_RAW], f"SELECT {_COLUMNS} FROM raw"),
    "bronze_lineage": _sql([_RAW], "SELECT feed_date, count(*) AS landed_rows, count(*) AS stamped_rows FROM raw GROUP BY 1"),
    "bronze_rescued": _sql(
        [_RAW],
        """SELECT transaction_id, amount, '{' || concat_ws(',',
             CASE WHEN event_id % 337 = 3 THEN '"amount":"N/A"' END,
             CASE WHEN event_id % 307 = 0 THEN '"promo_code":"P' || (event_id % 50) || '"' END) || '}'
             AS _rescued_data
           FROM raw WHERE event_id % 337 = 3 OR event_id % 307 = 0""",
    ),
    "feed_types": _sql([_RAW], _FIELD_TYPES),
    "stream_silver": _sql(_CLEAN, _SILVER_OUT),
    "stream_quarantine": _sql(_BAD, f"SELECT {_COLUMNS}, _quarantine_reason FROM rejected"),
    "stream_late": _sql(
        [*_CLEAN, _REJECTED],
        f"""SELECT {_COLUMNS}, CAST(NULL AS VARCHAR) AS _quarantine_reason FROM silver WHERE feed_date <> DATE '2024-01-15'
           UNION ALL SELECT {_COLUMNS}, _quarantine_reason FROM rejected
           UNION ALL SELECT {_COLUMNS}, 'late_event' FROM checked
           WHERE ok_id AND ok_ts AND ok_customer AND ok_amount AND feed_date = DATE '2024-01-15'""",
    ),
    "stream_restart": _sql(
        [*_CLEAN, _REJECTED],
        f"""SELECT {_COLUMNS}, CAST(NULL AS VARCHAR) AS _quarantine_reason FROM silver WHERE feed_date <> DATE '2024-01-15'
           UNION ALL SELECT {_COLUMNS}, _quarantine_reason FROM rejected
           UNION ALL SELECT {_COLUMNS}, 'late_event' FROM checked
           WHERE ok_id AND ok_ts AND ok_customer AND ok_amount AND feed_date = DATE '2024-01-15'""",
    ),
    "stream_repeated_id": _sql(_CLEAN, _SILVER_OUT),
    "stream_expectations": _sql([_RAW, _CHECKED], f"SELECT rule, passed_rows + failed_rows AS checked, passed_rows AS passed FROM ({_RULES})"),
    "backfill_late_day": _sql(
        [*_CLEAN, _REJECTED],
        f"""SELECT {_COLUMNS}, CAST(NULL AS VARCHAR) AS _quarantine_reason FROM silver
           UNION ALL SELECT {_COLUMNS}, _quarantine_reason FROM rejected""",
    ),
    "stream_backlog": _sql(
        [*_CLEAN, _REJECTED],
        f"""SELECT {_COLUMNS}, CAST(NULL AS VARCHAR) AS _quarantine_reason FROM silver
           UNION ALL SELECT {_COLUMNS}, _quarantine_reason FROM rejected""",
    ),
    "silver_transactions": _sql(_CLEAN, _SILVER_OUT),
    # Both copies of a duplicate carry the same defect, so the order of the steps does not show.
    "silver_dedup_first": _sql(_CLEAN, _SILVER_OUT),
    "silver_dedup": _sql([_ORDERS], f"SELECT {_COLUMNS} FROM purchases"),
    "silver_quarantine": _sql(_BAD, f"SELECT {_COLUMNS}, _quarantine_reason FROM rejected"),
    "expectation_metrics": _sql([_RAW, _CHECKED], _RULES),
    "gold_daily_kpis": _sql([*_CLEAN, _daily("silver")], "SELECT * FROM daily"),
    "gold_merchant_stats": _sql([*_CLEAN, _merchants("silver")], "SELECT * FROM merchants"),
    "gold_customer_profiles": _sql([*_CLEAN, _profiles("silver")], "SELECT * FROM profiles"),
    "gold_daily_kpis_orders": _sql([_ORDERS, _daily("purchases")], "SELECT * FROM daily"),
    "gold_merchant_stats_orders": _sql([_ORDERS, _merchants("purchases")], "SELECT * FROM merchants"),
    "gold_customer_profiles_orders": _sql([_ORDERS, _profiles("purchases")], "SELECT * FROM profiles"),
    "gold_running_merchants": _sql([*_CLEAN, _merchants("silver")], "SELECT * FROM merchants"),
    "gold_running_profiles": _sql([*_CLEAN, _profiles("silver")], "SELECT * FROM profiles"),
    "gold_running_profiles_orders": _sql([_ORDERS, _profiles("purchases")], "SELECT * FROM profiles"),
    "merchant_risk": _sql(
        [*_CLEAN, _BOUND, _TRAIN_RISK],
        f"SELECT merchant_id, {_r('merchant_fraud_rate', 8)} AS merchant_fraud_rate FROM risk",
    ),
    "time_split": _sql(
        [*_CLEAN, _BOUND],
        """SELECT transaction_id, event_ts,
             CASE WHEN CAST(event_ts AS DATE) <= (SELECT split_date FROM bound) THEN 'train' ELSE 'test' END
             AS split FROM silver""",
    ),
    "features": _sql([*_CLEAN, _BOUND, _TRAIN_RISK, _features("silver")], _SHOWN),
    "features_orders": _sql([_ORDERS, _risk("purchases"), _features("purchases")], _SHOWN),
    "class_weights": _sql(
        _CLEAN,
        f"""SELECT transaction_id, is_fraud, CASE WHEN is_fraud = 1 THEN
              {_r('(SELECT (1 - avg(is_fraud)) / avg(is_fraud) FROM silver)', 6)} ELSE 1.0 END AS weight
            FROM silver""",
    ),
    "threshold_curve": _sql([*_CLEAN, _CARDS, _CURVE], "SELECT * FROM curve"),
    "eval_pr_auc": _sql(
        [*_CLEAN, _CARDS, _CURVE, _PR_AUC], f"SELECT model, {_r('pr_auc', 6)} AS pr_auc FROM areas"
    ),
    "eval_roc_auc": _sql([*_CLEAN, _CARDS, _CURVE], _ROC_AUC),
    "eval_recall_at_fpr": _sql([*_CLEAN, _CARDS, _CURVE], _RECALL),
    "eval_precision_at_k": _sql([*_CLEAN, _CARDS], _precision("model", 200)),
    "eval_precision_at_k_daily": _sql([*_CLEAN, _CARDS], _precision("model, score_date", 40)),
    "promotion_gate": _sql([*_CLEAN, _CARDS, _CURVE, _PR_AUC], _GATE),
    "batch_score_alerts": _sql(_batch(_score(7919), _LAST_DATE), "SELECT * FROM preds"),
    "batch_score_points": _sql(_batch(_POINTS, _LAST_DATE), "SELECT * FROM preds"),
    "batch_score_backfill": _sql(_batch(_POINTS, "DATE '2024-01-15'"), "SELECT * FROM preds"),
    "batch_score_daystate": _sql(_batch(_POINTS, _LAST_DATE), "SELECT * FROM preds"),
    "batch_score_daystate_backfill": _sql(_batch(_POINTS, "DATE '2024-01-15'"), "SELECT * FROM preds"),
    "batch_score_budget": _sql(
        [*_CLEAN, _alerted("preds", "silver", _score(7919), 1, 40)], "SELECT * FROM preds"
    ),
    "upsert_predictions": _sql(
        [*_CLEAN, *_STORED],
        """SELECT * FROM first_load WHERE transaction_id NOT IN (SELECT transaction_id FROM second_load)
           UNION ALL SELECT * FROM second_load""",
    ),
    "upsert_rows": _sql(
        [_ORDERS],
        """SELECT transaction_id, event_ts, -amount AS amount FROM purchases WHERE is_fraud = 1
           UNION ALL
           SELECT transaction_id, event_ts, amount FROM purchases WHERE channel = 'online' AND is_fraud = 0""",
    ),
    "score_baseline_hist": _sql(
        [*_CLEAN, _BOUND, _BASELINE],
        f"""SELECT {_r('bin_low', 8)} AS bin_low, {_r('bin_high', 8)} AS bin_high,
              {_r('fraction', 8)} AS fraction, 1 AS model_version FROM baseline""",
    ),
    "monitoring_psi": _sql(
        _MONITORED,
        f"""SELECT monitor_date, {_r('psi', 6)} AS psi,
              CASE WHEN psi < 0.1 THEN 'STABLE' WHEN psi < 0.2 THEN 'WATCH' ELSE 'DRIFT' END AS band
            FROM drift""",
    ),
    "monitoring_effectiveness": _sql(_MONITORED, "SELECT * FROM effect"),
    "monitoring_metrics": _sql(_MONITORED, _METRICS),
    "upsert_monitoring": _sql([*_CLEAN, _BOUND, _PREDS, _STORED[1]], _UPSERT_MONITORING),
    "dash_01": _sql(
        [*_CLEAN, _daily("silver")], "SELECT * EXCLUDE (active_customers) FROM daily ORDER BY txn_date"
    ),
    "dash_02": _sql(
        [*_CLEAN, _daily("silver")],
        """SELECT txn_count, fraud_count, fraud_amount, active_customers FROM daily
           WHERE txn_date = (SELECT max(txn_date) FROM daily)""",
    ),
    "dash_03": _sql(
        [*_CLEAN, _PREDS],
        f"""SELECT p.transaction_id, p.event_ts, p.customer_id, p.amount, {_r('p.fraud_score', 3)} AS fraud_score,
              s.merchant_id, s.merchant_category, s.country, s.channel
            FROM preds p JOIN silver s ON s.transaction_id = p.transaction_id
            WHERE is_alert = 1 AND CAST(p.event_ts AS DATE) = {_LAST_DATE}""",
    ),
    "dash_04": _sql(
        [*_CLEAN, _merchants("silver")],
        f"""SELECT merchant_category, {_big('sum(fraud_count)')} AS fraud_count,
              {_r('sum(fraud_count) * 100.0 / CAST(sum(txn_count) AS DOUBLE)', 3)} AS fraud_rate_pct
            FROM merchants GROUP BY 1""",
    ),
    "dash_05": _sql(
        [*_CLEAN, _merchants("silver")],
        """SELECT * FROM merchants WHERE txn_count >= 50
           ORDER BY fraud_rate_pct DESC, merchant_id, merchant_category LIMIT 20""",
    ),
    "dash_06": _sql(
        _CLEAN,
        """SELECT CAST(event_ts AS DATE) AS txn_date, fraud_type, count(*) AS fraud_txns
           FROM silver WHERE is_fraud = 1 GROUP BY 1, 2""",
    ),
    "dash_07": _sql(
        _CLEAN,
        f"""SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day, channel, count(*) AS txns,
              {_r('avg(is_fraud) * 100', 3)} AS fraud_rate_pct FROM silver GROUP BY 1, 2""",
    ),
    "dash_08": _sql(
        _BAD,
        """SELECT DATE '2024-02-01' AS ingest_date, _quarantine_reason, count(*) AS rejected_rows
           FROM rejected GROUP BY 1, 2""",
    ),
    "dash_09": _sql(
        [*_CLEAN, _REJECTED],
        """SELECT (SELECT count(*) FROM raw) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
             (SELECT count(*) FROM rejected) AS quarantined_rows""",
    ),
    "dash_10": _sql(
        _MONITORED,
        f"""SELECT d.monitor_date, model_version, {_r('psi', 6)} AS psi, alert_count,
              {_r('alert_precision', 3)} AS alert_precision, {_r('fraud_recall', 3)} AS fraud_recall
            FROM days d JOIN drift USING (monitor_date) JOIN effect USING (monitor_date)""",
    ),
    "dash_11": _sql(
        [*_CLEAN, _PREDS],
        f"""SELECT CAST(floor(fraud_score * 10) / 10 AS DOUBLE) AS score_bucket, count(*) AS txns
            FROM preds WHERE {_LATEST} GROUP BY 1""",
    ),
    "dash_12": _sql(
        [*_CLEAN, _PREDS],
        f"""SELECT s.transaction_id, s.event_ts, s.customer_id, s.amount, s.fraud_type,
              {_r('p.fraud_score', 3)} AS fraud_score
            FROM silver s JOIN preds p ON s.transaction_id = p.transaction_id
            WHERE s.is_fraud = 1 AND p.is_alert = 0
            ORDER BY s.event_ts DESC, s.transaction_id LIMIT 50""",
    ),
    "runbook_quarantine_day": _sql(
        _BAD, "SELECT _quarantine_reason, count(*) AS rejected_rows FROM rejected GROUP BY 1"
    ),
    "star_fraud_by_month": _sql(
        _CLEAN,
        f"""SELECT strftime(event_ts, '%Y-%m') AS month, merchant_category AS category,
              {_r('sum(amount)', 2)} AS fraud_amount
            FROM silver WHERE is_fraud = 1 AND merchant_id IS NOT NULL GROUP BY 1, 2""",
    ),
    "train_logreg_optimum": _sql(
        [*_CLEAN, _BOUND],
        f"""SELECT term, TRUE AS optimal, train_rows, positives
           FROM (SELECT unnest({_TERMS}) AS term), (SELECT count(*) AS train_rows, {_big('sum(is_fraud)')} AS positives
             FROM silver WHERE CAST(event_ts AS DATE) <= (SELECT split_date FROM bound))""",
    ),
}
