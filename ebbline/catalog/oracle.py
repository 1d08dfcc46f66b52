"""Plain SQL for the catalog's queries, runnable by DuckDB on the same tables."""

from __future__ import annotations

from ebbline.catalog import study as S
from ebbline.functions.stamps import plus_days
from ebbline.operators.metrics import THRESHOLDS

TRAIN_BOUND = 1.0 - 0.15 - 0.15
VAL_BOUND = TRAIN_BOUND + 0.15
EPS = "1e-4"


def _round(x: str, digits: int = 6) -> str:
    scale = float(10**digits)
    return f"(CAST(floor(({x}) * {scale!r}e0 + 0.5e0) AS DOUBLE) / {scale!r}e0)"


# --- tables ----------------------------------------------------------------------------

B_ORDERS = """b_orders AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    o_orderdate + INTERVAL 14 DAY AS order_estimated_delivery_date,
    CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 11 <> 0
      THEN o_orderdate + to_days(CAST(3 + o_orderkey % 23 AS INTEGER)) END AS order_delivered_customer_date,
    CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day
  FROM orders)"""

B_CUSTOMERS = """b_customers AS (
  SELECT o_orderkey AS customer_id, c_custkey AS customer_unique_id, n_name AS customer_state,
    CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

B_PAYMENTS = f"""b_payments AS (
  SELECT l_orderkey AS order_id,
    CAST({_round('l_extendedprice * (1.0e0 - l_discount)', 2)} AS DECIMAL(18,2)) AS payment_value
  FROM lineitem)"""

BRONZE = ",\n".join([B_ORDERS, B_CUSTOMERS, B_PAYMENTS])


def _days(alias: str, start: str, end: str) -> str:
    """Whole days, both ends included."""
    day = f"make_date({alias}.year, {alias}.month, {alias}.day)"
    return f"{day} BETWEEN DATE '{start[:10]}' AND DATE '{end[:10]}'"


def _placed(start: str, end: str) -> str:
    return f"order_purchase_timestamp >= TIMESTAMP '{start}' AND order_purchase_timestamp < TIMESTAMP '{end}'"


def _visible(start: str, end: str) -> str:
    """An order whose delivery lies beyond the cutoff is still on its way."""
    known = f"order_delivered_customer_date <= TIMESTAMP '{end}'"
    return f"""SELECT order_id, customer_id, order_purchase_timestamp AS purchase_ts,
    order_estimated_delivery_date AS est_delivery_ts, if({known}, order_delivered_customer_date, NULL) AS act_delivery_ts,
    if(coalesce({known}, true), order_status, 'processing') AS order_status
  FROM b_orders WHERE {_placed(start, end)}"""


def _enriched(start: str, end: str) -> str:
    return f"""SELECT customer_unique_id, customer_state, order_id, purchase_ts, est_delivery_ts, act_delivery_ts, order_status,
    coalesce((SELECT sum(p.payment_value) FROM b_payments p WHERE p.order_id = v.order_id), 0) AS payment_value
  FROM ({_visible(start, end)}) v JOIN b_customers USING (customer_id)"""


def _features(end: str = S.CUTOFF, start: str = S.START) -> str:
    """Counts of days are differences of dates; what the cutoff hides is filtered out of each aggregate."""
    day = f"DATE '{end[:10]}'"
    known = f"order_delivered_customer_date <= TIMESTAMP '{end}'"
    late = "CAST(order_delivered_customer_date AS DATE) - CAST(order_estimated_delivery_date AS DATE)"
    return f"""SELECT customer_unique_id, any_value(customer_state) AS customer_state,
    {day} - CAST(max(order_purchase_timestamp) AS DATE) AS recency_days,
    {day} - CAST(min(order_purchase_timestamp) AS DATE) AS tenure_days,
    count(*) AS frequency, CAST(coalesce(sum(paid), 0) AS DOUBLE) AS monetary_total,
    CAST(coalesce(sum(paid), 0) AS DOUBLE) / count(*) AS aov,
    max({late}) FILTER (WHERE {known}) AS max_delivery_delay_days,
    CAST(NOT bool_and(coalesce({known}, false)) AS INTEGER) AS has_undelivered_order,
    count(*) FILTER (WHERE order_status = 'canceled' AND coalesce({known}, true)) AS total_canceled_orders,
    '{end}' AS snapshot_date
  FROM b_orders JOIN b_customers USING (customer_id)
    LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM b_payments GROUP BY 1) USING (order_id)
  WHERE {_placed(start, end)} GROUP BY 1"""


def _targets(end: str) -> str:
    return f"""SELECT customer_unique_id, count(*) AS future_orders, CAST(sum(paid) AS DOUBLE) AS future_ltv
  FROM b_orders JOIN b_customers USING (customer_id)
    LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM b_payments GROUP BY 1) USING (order_id)
  WHERE order_status <> 'canceled' AND {_placed(end, plus_days(end, S.WINDOW_DAYS))} GROUP BY 1"""


def _labelled(end: str = S.CUTOFF) -> str:
    """Churned is whoever does not exist among those who came back."""
    return f"""SELECT f.*, coalesce(future_ltv, 0.0e0) AS target_180d_ltv,
    CAST(t.customer_unique_id IS NULL AS INTEGER) AS target_is_churn
  FROM ({_features(end)}) f LEFT JOIN ({_targets(end)}) t USING (customer_unique_id)"""


DRAW = (
    f"CAST(CAST('0x' || substr(md5('{S.SEED}:' || CAST(customer_unique_id AS VARCHAR)), 1, 8) AS UBIGINT)"
    " AS DOUBLE) / 4294967296e0"
)
SPLIT = f"""SELECT *, CASE WHEN draw <= {TRAIN_BOUND!r}e0 THEN 'train'
    WHEN draw <= {VAL_BOUND!r}e0 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, {DRAW} AS draw FROM ({_labelled()}) l) d"""

RECENCY_SCORE = _round("1.0e0 / (1.0e0 + exp(-(recency_days - 180) / 90.0e0))")
FREQUENCY_SCORE = _round("1.0e0 / (1.0e0 + exp((frequency - 8) / 3.0e0))")

TEST_SCORES = f"""SELECT customer_unique_id, customer_state, target_is_churn, 'challenger' AS model,
    {RECENCY_SCORE} AS predicted_probability FROM ({SPLIT}) s WHERE split = 'test'
  UNION ALL SELECT customer_unique_id, customer_state, target_is_churn, 'champion' AS model,
    {FREQUENCY_SCORE} AS predicted_probability FROM ({SPLIT}) s WHERE split = 'test'"""

TRAIN = f"SELECT *, {RECENCY_SCORE} AS predicted_probability FROM ({SPLIT}) s WHERE split = 'train'"
TELEMETRY = f"""SELECT *, '{S.RUN}' AS inference_run_id,
    CAST(predicted_probability >= 0.5 AS INTEGER) AS is_churn_risk
  FROM (SELECT *, {RECENCY_SCORE} AS predicted_probability FROM ({_features(S.EXECUTION)}) f) s"""
LOOKBACK_SCORES = f"SELECT *, {RECENCY_SCORE} AS predicted_probability FROM ({_features(S.LOOKBACK)}) f"


def _with(body: str, **ctes: str) -> str:
    extra = "".join(f",\n{name} AS MATERIALIZED ({sql})" for name, sql in ctes.items())
    return f"WITH {BRONZE}{extra}\n{body}"


# --- profiles and drift ----------------------------------------------------------------


def _long(table: str, columns, kind: str = "DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {kind}) AS value FROM {table}" for c in columns
    )


PROFILED = (*S.NUMERICAL, S.PREDICTION)
PROFILE = dict(
    train=TRAIN,
    train_long=_long("train", PROFILED),
    ranked="""SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS place,
      count(*) OVER (PARTITION BY feature) AS n FROM train_long WHERE value IS NOT NULL""",
    cuts=f"""SELECT DISTINCT feature, value AS lo FROM ranked, range(0, {S.N_BINS + 1}) r(i)
      WHERE place = greatest(1, CAST(ceil((i / {S.N_BINS}.0e0) * n) AS BIGINT))""",
    edges="""SELECT feature, lo, lead(lo) OVER (PARTITION BY feature ORDER BY lo) AS hi,
      row_number() OVER (PARTITION BY feature ORDER BY lo) - 1 AS bin_no,
      count(*) OVER (PARTITION BY feature) AS n_cuts FROM cuts""",
    bins="""SELECT feature, CAST(bin_no AS INTEGER) AS bin_no, lo, COALESCE(hi, lo) AS hi, n_cuts,
      bin_no = 0 AS is_first, bin_no >= n_cuts - 2 AS is_last
      FROM edges WHERE hi IS NOT NULL OR n_cuts = 1""",
    shares="""SELECT b.feature, b.bin_no, b.lo, b.hi, is_first, is_last,
      count(t.value) / CAST(sum(count(t.value)) OVER (PARTITION BY b.feature) AS DOUBLE) AS expected_pct
      FROM bins b LEFT JOIN train_long t ON b.feature = t.feature
        AND (is_first OR t.value >= b.lo) AND (is_last OR t.value < b.hi)
      GROUP BY b.feature, b.bin_no, b.lo, b.hi, is_first, is_last""",
    states="""SELECT 'customer_state' AS feature, customer_state AS category,
      count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS expected_pct
      FROM train WHERE customer_state IS NOT NULL GROUP BY customer_state""",
)

MONITORED_NUMBERS = [
    f for f in (*S.MONITORED, S.PREDICTION) if f in PROFILED
]
DRIFT = dict(
    PROFILE,
    live=TELEMETRY,
    live_long=_long("live", MONITORED_NUMBERS),
    live_bins="""SELECT b.feature, b.bin_no, b.lo, b.hi, b.expected_pct, CAST(count(t.value) AS BIGINT) AS n
      FROM shares b JOIN (SELECT DISTINCT feature FROM live_long WHERE value IS NOT NULL) f USING (feature)
      LEFT JOIN live_long t ON b.feature = t.feature
        AND (is_first OR t.value >= b.lo) AND (is_last OR t.value < b.hi)
      GROUP BY ALL""",
    live_states="""SELECT s.feature, s.category, s.expected_pct, CAST(count(t.customer_state) AS BIGINT) AS n
      FROM states s LEFT JOIN live t ON s.category = t.customer_state GROUP BY ALL""",
)


def _live_cells(rows: str) -> tuple[str, str]:
    """Numerical bins and states of some live rows, as in `live_bins` and `live_states`."""
    long = f"({_long(rows, MONITORED_NUMBERS)})"
    bins = f"""SELECT b.feature, b.bin_no, b.lo, b.hi, b.expected_pct, CAST(count(t.value) AS BIGINT) AS n
      FROM shares b JOIN (SELECT DISTINCT feature FROM {long} l WHERE value IS NOT NULL) f USING (feature)
      LEFT JOIN {long} t ON b.feature = t.feature
        AND (is_first OR t.value >= b.lo) AND (is_last OR t.value < b.hi) GROUP BY ALL"""
    states = f"""SELECT s.feature, s.category, s.expected_pct, CAST(count(t.customer_state) AS BIGINT) AS n
      FROM states s LEFT JOIN {rows} t ON s.category = t.customer_state GROUP BY ALL"""
    return f"({bins})", f"({states})"


def _psi(cells: str) -> str:
    return f"""SELECT feature, sum((a / sa - e / se) * ln((a / sa) / (e / se))) AS psi FROM (
    SELECT feature, a, e, sum(a) OVER (PARTITION BY feature) AS sa, sum(e) OVER (PARTITION BY feature) AS se
    FROM (SELECT feature, greatest(n / CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE), {EPS}) AS a,
      greatest(expected_pct, {EPS}) AS e FROM {cells}) x) y GROUP BY feature"""


PSI = dict(DRIFT, psi=f"{_psi('live_bins')} UNION ALL {_psi('live_states')}")
REQUESTED = ", ".join(
    f"('{'prediction' if i == 0 else 'feature'}', '{f}')" for i, f in enumerate((S.PREDICTION, *S.MONITORED))
)
REPORT = dict(
    PSI,
    report=f"""SELECT '{S.MODEL}' AS model_run_id, '{S.EXECUTION}' AS execution_date, r.scope, r.feature,
      CASE WHEN r.feature = 'no_such_feature' THEN 0.0e0 ELSE {_round('COALESCE(p.psi, 0.0e0)', 4)} END AS psi_score,
      CASE WHEN r.feature = 'no_such_feature' THEN 'MISSING_IN_TELEMETRY' ELSE 'CALCULATED' END AS status
      FROM (VALUES {REQUESTED}) r(scope, feature) LEFT JOIN psi p USING (feature)""",
)

LOG_LOSS = """avg(-(y * ln(least(greatest(p, 1e-15), 1e0 - 1e-15))
  + (1.0e0 - y) * ln(1.0e0 - least(greatest(p, 1e-15), 1e0 - 1e-15))))"""

EVALUATION = f"""SELECT s.customer_unique_id, s.predicted_probability, l.target_is_churn
  FROM ({LOOKBACK_SCORES}) s JOIN ({_labelled(S.LOOKBACK)}) l USING (customer_unique_id)"""

PERFORMANCE = f"""SELECT count(*) > 0 AS is_evaluated, CAST(NULL AS VARCHAR) AS reason, count(*) AS n_rows,
    count(*) AS n_clean, avg((p - y) * (p - y)) AS brier_score, {LOG_LOSS} AS log_loss,
    sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) * 0.20e0 * 150.0e0
      - sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) * 10.0e0 AS realized_roi
  FROM (SELECT predicted_probability AS p, CAST(target_is_churn AS DOUBLE) AS y FROM evaluation) e"""

VERDICT = dict(
    REPORT,
    evaluation=EVALUATION,
    perf=PERFORMANCE,
    base=f"""SELECT avg((p - y) * (p - y)) AS brier FROM (SELECT predicted_probability AS p,
      CAST(target_is_churn AS DOUBLE) AS y FROM ({TEST_SCORES}) t WHERE model = 'challenger') b""",
    facts="""SELECT
      (SELECT max(psi_score) FROM report WHERE scope = 'prediction') AS prediction_psi,
      (SELECT count(*) FROM report WHERE scope = 'feature' AND psi_score >= 0.02) AS n_drifted,
      (SELECT COALESCE(string_agg(feature, ',' ORDER BY feature), '') FROM report
        WHERE scope = 'feature' AND psi_score >= 0.02) AS names,
      (SELECT brier_score FROM perf) AS brier, (SELECT brier * 1.05e0 FROM base) AS boundary""",
)

# --- metrics ---------------------------------------------------------------------------

SCORES = dict(scores=TEST_SCORES)
# Missing probabilities are NULL here; the queries meet them as NULL and as NaN.
GAPPY = "CASE WHEN customer_unique_id % 10 NOT IN (3, 7) THEN predicted_probability END"
GAPS = dict(scores=f"SELECT * REPLACE ({GAPPY} AS predicted_probability) FROM ({TEST_SCORES}) t")


def _proper(table: str, keys: str) -> str:
    return f"""SELECT {keys}, avg((p - y) * (p - y)) AS brier_score, {LOG_LOSS} AS log_loss
  FROM (SELECT *, predicted_probability AS p, CAST(target_is_churn AS DOUBLE) AS y FROM {table}) x GROUP BY {keys}"""


def _auc(table: str, keys: str) -> str:
    """Rank-sum form with average ranks, which gives ties one half."""
    return f"""SELECT {keys}, (sum(CASE WHEN y = 1 THEN mid ELSE 0 END) - npos * (npos + 1) / 2.0e0)
      / NULLIF(npos * nneg, 0) AS roc_auc
  FROM (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY p)
        + (count(*) OVER (PARTITION BY {keys}, p) - 1) / 2.0e0 AS mid,
      CAST(sum(y) OVER (PARTITION BY {keys}) AS DOUBLE) AS npos,
      CAST(sum(1 - y) OVER (PARTITION BY {keys}) AS DOUBLE) AS nneg
    FROM (SELECT *, predicted_probability AS p, target_is_churn AS y FROM {table}) x) r
  GROUP BY {keys}, npos, nneg"""


GRID = ", ".join(f"({t!r}e0)" for t in THRESHOLDS)


def _sweep(table: str, keys: str) -> str:
    return f"""SELECT {keys}, threshold, CAST(sum(CASE WHEN p >= threshold AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN p >= threshold AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp, count(*) AS n
  FROM (SELECT *, predicted_probability AS p, target_is_churn AS y FROM {table}) x, (VALUES {GRID}) g(threshold)
  GROUP BY {keys}, threshold"""


def _returns(table: str, keys: str) -> str:
    return f"""SELECT {keys}, threshold, tp, fp, (tp * {500.0 * 0.10!r}e0 - (tp + fp) * 10.0e0) / n AS eroi
  FROM ({_sweep(table, keys)}) s"""


def _best(table: str, keys: str) -> str:
    return f"""SELECT {keys}, eroi, threshold AS optimal_threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY eroi DESC, threshold) AS place
    FROM ({_returns(table, keys)}) r) q WHERE place = 1"""


def _metrics(table: str, keys: str) -> str:
    return f"""SELECT * FROM ({_proper(table, keys)}) a JOIN ({_auc(table, keys)}) b USING ({keys})
    JOIN ({_best(table, keys)}) c USING ({keys})"""


DUEL = dict(
    SCORES,
    challenger="SELECT * FROM scores WHERE model = 'challenger'",
    champion="SELECT * FROM scores WHERE model = 'champion' ",
    rivals=f"""SELECT c.*, h.customer_state IS NOT NULL AS has_champion, h.eroi AS champion_eroi,
      h.log_loss AS champion_log_loss, h.roc_auc AS champion_roc_auc, h.brier_score AS champion_brier_score,
      h.optimal_threshold AS champion_optimal_threshold,
      CASE WHEN h.customer_state IS NOT NULL THEN c.eroi >= h.eroi + 0.02e0 ELSE c.eroi >= 0.05e0 END AS is_approved
      FROM ({_metrics('challenger', 'customer_state')}) c
      LEFT JOIN ({_metrics('champion', 'customer_state')}) h ON c.customer_state = h.customer_state""",
)


def _draw(seed: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST(customer_unique_id AS VARCHAR)), 1, 8) AS UBIGINT)"


def _place(seed: str) -> str:
    return f"row_number() OVER (ORDER BY {_draw(seed)}, customer_unique_id)"


def _mean_loss(days: str) -> str:
    """Log loss of the recency score at the given number of days."""
    score = _round(f"1.0e0 / (1.0e0 + exp(-({days} - 180) / 90.0e0))")
    inside = f"least(greatest({score}, 1e-15), 1e0 - 1e-15)"
    return f"avg(-(if(target_is_churn = 1, ln({inside}), ln(1.0e0 - {inside}))))"


def _kept(name: str) -> str:
    return f"CASE WHEN is_approved THEN {name} ELSE champion_{name} END"


# --- windows ---------------------------------------------------------------------------

def _day_text(table: str) -> str:
    """Keys of a day as zero-padded text."""
    return ", ".join(f"lpad(CAST({table}.{part} AS VARCHAR), {n}, '0') AS {part}" for part, n in (("year", 4), ("month", 2), ("day", 2)))


PAYMENTS_BY_DAY = f"""SELECT order_id, CAST(payment_value AS DOUBLE) AS payment_value, {_day_text('o')}
  FROM b_payments JOIN b_orders o USING (order_id)"""

MONTH_RANGE = "year * 12 + month BETWEEN 1997 * 12 + 3 AND 1998 * 12 + 2"


def _nulls(table: str, source: str, column: str, where: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
      CAST(COALESCE(sum(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_null FROM {source} t WHERE {where}"""


def _order_window(start: str, end: str) -> str:
    return (
        f"{_days('t', start, end)} AND order_purchase_timestamp >= TIMESTAMP '{start}'"
        f" AND order_purchase_timestamp < TIMESTAMP '{end}'"
    )


WINDOW = _order_window(S.START, S.CUTOFF)
NUMERIC_UNION = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {_round(f'avg({c})')} AS mean, {_round(f'stddev_samp({c})')} AS std,
    CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
    {_round(f'avg(CASE WHEN {c} IS NULL THEN 1.0e0 ELSE 0.0e0 END)')} AS missing_rate FROM train"""
    for c in S.NUMERICAL
)
IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_round(f'abs(corr(CAST({c} AS DOUBLE), CAST(target_is_churn AS DOUBLE)))')} AS importance FROM train"
    for c in S.NUMERICAL
)
CONTRACT_NAMES = ", ".join(f"('{c}')" for c in (*S.NUMERICAL, "customer_unique_id", "snapshot_date"))
LABELLED_NAMES = "".join(
    ("customer_unique_id", "customer_state", "recency_days", "tenure_days", "frequency", "monetary_total", "aov",
     "max_delivery_delay_days", "has_undelivered_order", "total_canceled_orders", "snapshot_date",
     "target_180d_ltv", "target_is_churn")
)


ORACLE: dict[str, str] = {
    "feature_matrix": _with(_features()),
    "feature_snapshots": _with(" UNION ALL ".join(f"SELECT * FROM ({_features(day)}) f" for day in S.SNAPSHOTS)),
    "masked_orders": _with(_visible(S.START, S.CUTOFF)),
    "payments_per_order": _with(
        "SELECT order_id, CAST(SUM(payment_value) AS DOUBLE) AS order_payment_value FROM b_payments GROUP BY order_id"
    ),
    "enriched_orders": _with(
        f"SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM ({_enriched(S.START, S.CUTOFF)}) e"
    ),
    "future_targets": _with(_targets(S.CUTOFF)),
    "training_table": _with(_labelled()),
    "row_count": _with(f"SELECT count(*) AS n_rows FROM ({_labelled()}) l"),
    "partition_orders": _with(
        f"SELECT order_id, order_status, order_purchase_timestamp, {_day_text('o')} FROM b_orders o"
    ),
    "partition_customers": _with(
        f"SELECT customer_id, customer_unique_id, customer_state, {_day_text('c')} FROM b_customers c"
    ),
    "partition_payments": _with(PAYMENTS_BY_DAY),
    "pruned_scan": _with(
        f"""SELECT order_id, order_purchase_timestamp, year, month, day FROM b_orders o
        WHERE {_days('o', S.SCAN_START, S.SCAN_END)}"""
    ),
    "lake_roundtrip": _with(
        """SELECT order_id, CAST(payment_value AS DOUBLE) AS payment_value, year, month, day
        FROM b_payments JOIN b_orders USING (order_id)"""
    ),
    "ingest_roundtrip": _with("SELECT customer_id, customer_unique_id, customer_state FROM b_customers"),
    "run_table": _with(_labelled()),
    "published_day": _with(f"SELECT *, 'CURRENT_TELEMETRY_RESOLVED' AS status FROM ({TELEMETRY}) t"),
    "evaluation_day": _with("SELECT * FROM evaluation", evaluation=EVALUATION),
    "required_columns": _with(
        """SELECT 'orders' AS table_name, 'order_status' AS column_name, count(*) AS n_rows FROM b_orders
        UNION ALL SELECT 'customers', unnest(['customer_id', 'customer_unique_id']), count(*) FROM b_customers"""
    ),
    "multiline_csv": _with(
        """SELECT customer_id, customer_state, 'said "' || customer_state || '",' || chr(10) || 'then' || chr(10) || chr(10)
        || repeat('x "' || chr(10), CAST(customer_id % 7 AS INTEGER)) AS note FROM b_customers"""
    ),
    "published_report": _with(
        f"""SELECT customer_unique_id, predicted_probability AS churn_probability,
        CAST(predicted_probability >= 0.5 AS INTEGER) AS is_churn_risk,
        {_round('predicted_probability * monetary_total', 2)} AS revenue_at_risk, inference_run_id,
        predicted_probability, 2001 AS year, 7 AS month, 1 AS day FROM ({TELEMETRY}) t"""
    ),
    "empty_matrix": _with(
        f"""SELECT '{S.START}' AS start_date, '{S.CUTOFF}' AS end_date, count(*) AS n_rows, count(*) = 0 AS is_halted
        FROM ({_features()}) f UNION ALL SELECT '{S.BEFORE_ALL[0]}', '{S.BEFORE_ALL[1]}', 0, true"""
    ),
    "partition_months": _with(
        f"""SELECT DISTINCT 'orders' AS dataset, year, month FROM b_orders WHERE {MONTH_RANGE}
        UNION SELECT DISTINCT 'customers', year, month FROM b_customers WHERE {MONTH_RANGE}
        UNION SELECT DISTINCT 'order_payments', year, month FROM (
          SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month FROM ({PAYMENTS_BY_DAY}) p) q
          WHERE {MONTH_RANGE}"""
    ),
    "day_partition": _with(
        f"""SELECT CAST(d AS VARCHAR) AS day, CAST(b AS VARCHAR) AS lookback_day, COALESCE(x.n, 0) AS n_rows,
        CASE WHEN x.n > 0 THEN 'CURRENT_TELEMETRY_RESOLVED' ELSE 'SKIPPED_ZERO_TRAFFIC_DAY' END AS status,
        COALESCE(y.n, 0) AS n_lookback_rows,
        CASE WHEN y.n > 0 THEN 'MATURED_EVALUATION_READY' ELSE 'SKIPPED_SYSTEM_IMMATURE' END AS lookback_status
        FROM (SELECT CAST(t AS DATE) AS d, CAST(t - INTERVAL 30 DAY AS DATE) AS b FROM generate_series(
          TIMESTAMP '{S.CALENDAR_START}', TIMESTAMP '{S.CALENDAR_END}', INTERVAL 1 DAY) g(t)) c
        LEFT JOIN per_day x ON c.d = x.placed LEFT JOIN per_day y ON c.b = y.placed""",
        per_day="SELECT make_date(year, month, day) AS placed, count(*) AS n FROM b_customers GROUP BY 1",
    ),
    "window_counts": _with(
        f"""SELECT 'orders' AS table_name, count(*) AS n_rows FROM b_orders t WHERE {WINDOW}
        UNION ALL SELECT 'customers', count(*) FROM b_customers t WHERE {_days('t', S.START, S.CUTOFF)}
        UNION ALL SELECT 'order_payments', count(*) FROM b_payments"""
    ),
    "null_counts": _with(
        " UNION ALL ".join(
            [_nulls("orders", "b_orders", c, WINDOW)
             for c in ("order_id", "customer_id", "order_status", "order_purchase_timestamp")]
            + [_nulls("customers", "b_customers", c, _days("t", S.START, S.CUTOFF))
               for c in ("customer_id", "customer_unique_id")]
            + [_nulls("order_payments", "b_payments", c, "true") for c in ("order_id", "payment_value")]
        )
    ),
    "gate_violations": _with(
        f"""SELECT * FROM (SELECT 'orders' AS table_name, 'nulls' AS check_name, 'order_status' AS column_name,
          count(*) AS n, 'WARN' AS severity FROM b_orders t
          WHERE order_status = 'shipped' AND {_order_window('2001-01-01', '2001-06-01')}) v WHERE n > 0
        UNION ALL SELECT 'orders', 'right_censored', 'order_purchase_timestamp', NULL, 'WARN'
          FROM (SELECT max(order_purchase_timestamp) AS last_seen FROM b_orders) m
          WHERE NOT last_seen >= TIMESTAMP '2001-06-01' + INTERVAL {S.WINDOW_DAYS} DAY
        UNION ALL SELECT * FROM (SELECT 'customers', 'repeated_key', 'customer_id', count(*) AS n, 'WARN'
          FROM (SELECT customer_unique_id FROM b_customers GROUP BY 1 HAVING count(*) > 1) r) k WHERE n > 0"""
    ),
    "contract_missing": _with(
        f"""SELECT name FROM (VALUES {CONTRACT_NAMES}) e(name) WHERE name IN ('aov', 'snapshot_date')
        UNION SELECT 'customer_state' FROM train WHERE customer_state IS NOT NULL""",
        train=TRAIN,
    ),
    "schema_fingerprint": _with(
        f"""SELECT substr(md5('{LABELLED_NAMES}'), 1, 10) AS columns_hash, count(*) AS row_count,
        '{S.START}' AS start_date, '{S.CUTOFF}' AS end_date FROM ({_labelled()}) l"""
    ),
    "hash_split": _with(f"SELECT customer_unique_id, split FROM ({SPLIT}) s"),
    "split_sizes": _with(
        f"SELECT split, count(*) AS n_rows, CAST(9 AS INTEGER) AS n_features FROM ({SPLIT}) s GROUP BY split"
    ),
    "feature_set": _with(
        f"""SELECT * EXCLUDE (customer_unique_id, snapshot_date, target_180d_ltv, target_is_churn)
        REPLACE ({_round('aov')} AS aov) FROM ({_labelled()}) l"""
    ),
    "category_lists": _with(
        """SELECT DISTINCT 'customer_state' AS feature, customer_state AS category FROM train
        WHERE customer_state IS NOT NULL""",
        train=TRAIN,
    ),
    "schema_enforced": _with(
        f"""SELECT customer_unique_id, CAST(recency_days AS DOUBLE) AS recency_days,
        CAST(tenure_days AS DOUBLE) AS tenure_days,
        CASE WHEN has_undelivered_order = 1 THEN NULL ELSE CAST(frequency AS DOUBLE) END AS frequency, monetary_total,
        CAST(NULL AS DOUBLE) AS aov, CAST(max_delivery_delay_days AS DOUBLE) AS max_delivery_delay_days,
        CAST(has_undelivered_order AS DOUBLE) AS has_undelivered_order,
        CAST(total_canceled_orders AS DOUBLE) AS total_canceled_orders,
        CASE WHEN recency_days <= 300 AND customer_state IN (SELECT customer_state FROM train)
          THEN customer_state END AS customer_state
        FROM ({_features()}) f""",
        train=TRAIN,
    ),
    "profile_numeric": _with(NUMERIC_UNION, train=TRAIN),
    "profile_categorical": _with(
        f"""SELECT 'customer_state' AS feature, customer_state AS category,
        {_round("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)")} AS frequency,
        {_round("(SELECT avg(CASE WHEN customer_state IS NULL THEN 1.0e0 ELSE 0.0e0 END) FROM train)")} AS missing_rate
        FROM train WHERE customer_state IS NOT NULL GROUP BY customer_state""",
        train=TRAIN,
    ),
    "profile_bins": _with(
        f"""SELECT feature, 'numerical' AS kind, bin_no, lo, hi, CAST(NULL AS VARCHAR) AS category,
        {_round('expected_pct')} AS expected_pct FROM shares
        UNION ALL SELECT feature, 'categorical', NULL, NULL, NULL, category, {_round('expected_pct')} FROM states""",
        **PROFILE,
    ),
    "brier_logloss": _with(
        f"""SELECT model, {_round('brier_score')} AS brier_score, {_round('log_loss')} AS log_loss
        FROM ({_proper('scores', 'model')}) x""",
        **SCORES,
    ),
    "roc_auc": _with(
        f"SELECT model, customer_state, {_round('roc_auc')} AS roc_auc FROM ({_auc('scores', 'model, customer_state')}) x",
        **SCORES,
    ),
    "realised_roi": _with(
        """SELECT model, sum(CASE WHEN predicted_probability >= 0.5 AND target_is_churn = 1 THEN 1 ELSE 0 END)
          * 0.20e0 * 150.0e0 - sum(CASE WHEN predicted_probability >= 0.5 THEN 1 ELSE 0 END) * 10.0e0 AS realized_roi
        FROM scores GROUP BY model""",
        **GAPS,
    ),
    "threshold_sweep": _with(
        f"SELECT model, threshold, tp, fp, {_round('eroi')} AS eroi FROM ({_returns('scores', 'model')}) x", **GAPS
    ),
    "best_threshold": _with(
        f"SELECT model, {_round('eroi')} AS eroi, optimal_threshold FROM ({_best('scores', 'model')}) x", **GAPS
    ),
    "model_metrics": _with(
        f"""SELECT model, {_round('brier_score')} AS brier_score, {_round('log_loss')} AS log_loss,
        {_round('roc_auc')} AS roc_auc, {_round('eroi')} AS eroi, optimal_threshold
        FROM ({_metrics('scores', 'model')}) x""",
        **SCORES,
    ),
    "model_duel": _with(
        f"""SELECT customer_state, {_round('eroi')} AS eroi, {_round('champion_eroi')} AS champion_eroi,
        has_champion, is_approved FROM rivals""",
        **DUEL,
    ),
    "baseline_record": _with(
        f"""SELECT customer_state, {_round(_kept('log_loss'))} AS log_loss, {_round(_kept('roc_auc'))} AS roc_auc,
        {_round(_kept('brier_score'))} AS brier_score, {_kept('optimal_threshold')} AS optimal_decision_threshold,
        {_round(_kept('eroi'))} AS expected_roi_per_user FROM rivals WHERE is_approved OR has_champion""",
        **DUEL,
    ),
    "business_report": _with(
        f"""SELECT customer_unique_id, p AS churn_probability, CAST(coalesce(p >= 0.5, false) AS INTEGER) AS is_churn_risk,
        {_round('p * monetary_total', 2)} AS revenue_at_risk
        FROM (SELECT * REPLACE ({GAPPY} AS predicted_probability), {GAPPY} AS p
          FROM (SELECT *, {RECENCY_SCORE} AS predicted_probability FROM ({_features()}) f) g) s
        ORDER BY revenue_at_risk DESC, customer_unique_id"""
    ),
    "impact_summary": _with(
        f"""SELECT count(*) AS total_customers_scored,
        CAST(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS total_churners_flagged,
        CAST(sum(CAST({_round('p * monetary_total', 2)} AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_at_risk_flagged
        FROM (SELECT *, {RECENCY_SCORE} AS p FROM ({_features()}) f) s"""
    ),
    "telemetry": _with(TELEMETRY),
    "matured_labels": _with("SELECT customer_unique_id, target_is_churn FROM evaluation", evaluation=EVALUATION),
    "evaluation_join": _with(
        "SELECT * FROM evaluation WHERE predicted_probability <= 0.9", evaluation=EVALUATION
    ),
    "importance_fixed_score": _with(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS feature, {_round('shuffled - plain')} AS importance
            FROM (SELECT {_mean_loss('lent' if name == 'recency_days' else 'recency_days')} AS shuffled FROM at_rows
              JOIN (SELECT {name} AS lent, {_place(f'shuffle-{S.SEED}-{name}')} AS place FROM train) USING (place)),
              (SELECT {_mean_loss('recency_days')} AS plain FROM train)"""
            for name in ("recency_days", "frequency")
        ),
        train=TRAIN,
        at_rows=f"SELECT *, {_place(f'rows-{S.SEED}')} AS place FROM train",
    ),
    "top_features": _with(
        f"SELECT * FROM ({IMPORTANCE}) i ORDER BY importance DESC, feature LIMIT 5", train=TRAIN
    ),
    "bin_counts": _with(
        f"SELECT feature, bin_no, lo, hi, {_round('expected_pct')} AS expected_pct, n FROM live_bins", **DRIFT
    ),
    "category_counts": _with(
        f"SELECT feature, category, {_round('expected_pct')} AS expected_pct, n FROM live_states", **DRIFT
    ),
    "psi_numeric": _with(f"SELECT feature, {_round('psi')} AS psi FROM ({_psi('live_bins')}) p", **DRIFT),
    "psi_categorical": _with(f"SELECT feature, {_round('psi')} AS psi FROM ({_psi('live_states')}) p", **DRIFT),
    "drift_report": _with("SELECT * FROM report", **REPORT),
    "performance_report": _with(
        f"""SELECT is_evaluated, reason, n_rows, n_clean, {_round('brier_score')} AS brier_score,
        {_round('log_loss')} AS log_loss, {_round('realized_roi')} AS realized_roi FROM perf""",
        evaluation=EVALUATION,
        perf=PERFORMANCE,
    ),
    "rule_evaluations": _with(
        f"""SELECT '{S.MODEL}' AS model_run_id, '{S.EXECUTION}' AS execution_date, rule, metric, is_triggered,
        CASE WHEN is_triggered THEN 'CRITICAL' ELSE 'INFO' END AS severity_level,
        {_round('actual_value')} AS actual_value, {_round('threshold')} AS threshold, note
        FROM (SELECT 1 AS rule, 'predicted_probability_psi' AS metric, prediction_psi >= 0.02 AS is_triggered,
            CAST(prediction_psi AS DOUBLE) AS actual_value, 0.02e0 AS threshold, CAST(NULL AS VARCHAR) AS note FROM facts
          UNION ALL SELECT 2, 'drifted_top_features_count', n_drifted >= 2, n_drifted, 2, names FROM facts
          UNION ALL SELECT 3, 'brier_score_degradation', brier > boundary, brier, boundary, NULL FROM facts) r""",
        **VERDICT,
    ),
    "decision": _with(
        f"""SELECT '{S.MODEL}' AS model_run_id, '{S.EXECUTION}' AS execution_date,
        prediction_psi >= 0.02 OR n_drifted >= 2 OR brier > boundary AS need_update,
        COALESCE(NULLIF(concat_ws(' | ', CASE WHEN prediction_psi >= 0.02 THEN 'CRITICAL_PREDICTION_DRIFT' END,
          CASE WHEN n_drifted >= 2 THEN 'CRITICAL_FEATURE_DRIFT' END,
          CASE WHEN brier > boundary THEN 'SEVERE_PERFORMANCE_DEGRADATION' END), ''), 'NONE') AS trigger_reasons
        FROM facts""",
        **VERDICT,
    ),
}

# --- encodings, curves and contributions -----------------------------------------------

CODE_FOLD = f"CAST(floor(CAST({_draw('code-42')} AS DOUBLE) / 4294967296e0 * 5) AS INTEGER)"
CODES = {
    "train": TRAIN,
    "rows": f"SELECT customer_unique_id, customer_state, target_is_churn AS hit, {CODE_FOLD} AS fold FROM train",
    # Fold -1 stands for no fold: what is learnt from all rows.
    "folds": "SELECT unnest([-1, 0, 1, 2, 3, 4]) AS of_fold",
    "priors": "SELECT of_fold, avg(hit) AS prior FROM rows JOIN folds ON fold <> of_fold GROUP BY 1",
    "learnt": """SELECT customer_state AS value, of_fold, count(*) FILTER (fold <> of_fold) AS n,
      coalesce(sum(hit) FILTER (fold <> of_fold), 0) AS hits, count(*) FILTER (fold = of_fold) AS own
      FROM rows, folds GROUP BY 1, 2""",
    "codes": """SELECT value, of_fold, n, (hits + 20.0e0 * prior) / (n + 20.0e0) AS code
      FROM learnt JOIN priors USING (of_fold) WHERE own > 0 OR of_fold = -1""",
}
CURVE = {
    "points": f"""SELECT row_number() OVER (ORDER BY predicted_probability) AS i, predicted_probability AS x,
      sum(target_is_churn) AS hits, count(*) AS n FROM ({TRAIN}) t GROUP BY predicted_probability""",
    # The fit at a point: over all beginnings up to it, the greatest of the least means of what ends from it on.
    "sums": """SELECT i, x, n, sum(hits) OVER w AS upto_hits, sum(n) OVER w AS upto_n,
      sum(hits) OVER w - hits AS before_hits, sum(n) OVER w - n AS before_n FROM points WINDOW w AS (ORDER BY i)""",
    "means": """SELECT a.i AS a, b.i AS b,
      min(CAST(b.upto_hits - a.before_hits AS DOUBLE) / CAST(b.upto_n - a.before_n AS DOUBLE))
        OVER (PARTITION BY a.i ORDER BY b.i DESC) AS least FROM sums a JOIN sums b ON a.i <= b.i""",
    "fit": "SELECT m.b AS i, max(least) AS value FROM means m GROUP BY 1",
    "blocks": """SELECT min(x) AS low, max(x) AS high, CAST(sum(n) AS DOUBLE) AS weight, value
      FROM points JOIN fit USING (i) GROUP BY value""",
}
_CALIBRATED = """CASE WHEN low IS NULL THEN (SELECT value FROM turns ORDER BY low LIMIT 1)
    WHEN x <= high OR next_low IS NULL THEN value
    ELSE value + (x - high) * ((next_value - value) / (next_low - high)) END"""
# What the fixed trees ask.
_RECENT, _FEW, _RARE = "recency_days <= 200", "frequency <= 2", "frequency <= 5"

ORACLE |= {
    "category_codes": _with(
        f"""SELECT 'customer_state' AS feature, value, CAST(nullif(of_fold, -1) AS INTEGER) AS fold, n,
        {_round('code')} AS code FROM codes""",
        **CODES,
    ),
    "encoded_categories": _with(
        f"""SELECT customer_unique_id, {_round('code')} AS customer_state_code FROM rows r
        JOIN codes c ON c.of_fold = r.fold AND c.value IS NOT DISTINCT FROM r.customer_state""",
        **CODES,
    ),
    "isotonic_fit": _with(f"SELECT low, high, weight, {_round('value')} AS value FROM blocks", **CURVE),
    "isotonic_scores": _with(
        f"""SELECT customer_unique_id, {_round(_CALIBRATED)} AS calibrated
        FROM tested ASOF LEFT JOIN turns ON x >= low""",
        **CURVE,
        turns="""SELECT *, lead(low) OVER (ORDER BY low) AS next_low, lead(value) OVER (ORDER BY low) AS next_value
          FROM blocks""",
        tested=f"SELECT customer_unique_id, {RECENCY_SCORE} AS x FROM ({SPLIT}) s WHERE split = 'test'",
    ),
    "fixed_contributions": _with(
        f"""SELECT customer_unique_id, {_round('by_recency')} AS by_recency,
        {_round('by_frequency')} AS by_frequency, {_round('base')} AS base,
        {_round('base + by_recency + by_frequency')} AS margin
      FROM (SELECT customer_unique_id, if({_RECENT}, -0.5e0, 0.5e0) AS by_recency,
          if({_RECENT}, if({_FEW}, 0.3e0, -0.3e0), 0e0) + if({_RARE}, 0.09e0, -0.16e0) AS by_frequency,
          0.11e0 AS base FROM ({TRAIN}) t) c"""
    ),
}

# Three days of five, by the remainder of the id.
_WINDOWS = {S.COUNTED_DAYS[2]: "0, 1, 2", S.COUNTED_DAYS[4]: "2, 3, 4"}
ORACLE["drift_windows"] = _with(
    " UNION ALL ".join(
        f"""SELECT '{end}' AS window_end, feature, {_round('psi')} AS psi
        FROM (SELECT * FROM ({_psi(cells)}) x) p"""
        for k, end in enumerate(_WINDOWS)
        for cells in _live_cells(f"live_{k}")
    ),
    **DRIFT,
    **{
        f"live_{k}": f"SELECT * FROM live WHERE customer_unique_id % 5 IN ({ids})"
        for k, ids in enumerate(_WINDOWS.values())
    },
)
