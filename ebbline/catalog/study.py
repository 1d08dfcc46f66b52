"""Windows, models and money used by the catalog on both sides of the comparison."""

from __future__ import annotations

from ebbline.names import PREDICTION  # noqa: F401  (S.PREDICTION)

START = "1996-01-01"
CUTOFF = "2000-01-01"
EXECUTION = "2001-07-01"
LOOKBACK_DAYS = 180
LOOKBACK = "2001-01-02"
SNAPSHOTS = (EXECUTION, CUTOFF, LOOKBACK)
WINDOW_DAYS = 180
SEED = 42
RUN = "run-2001-07-01"
MODEL = "model-2000-01-01"

SCAN_START, SCAN_END = "1997-03-15", "1998-02-10 12:00:00"
BEFORE_ALL = ("1980-01-01", "1980-06-01")
CALENDAR_START, CALENDAR_END = "1994-12-20", "1995-03-10"

NUMERICAL = (
    "recency_days",
    "tenure_days",
    "frequency",
    "monetary_total",
    "aov",
    "max_delivery_delay_days",
    "has_undelivered_order",
    "total_canceled_orders",
)
CATEGORICAL = ("customer_state",)
MONITORED = ("recency_days", "tenure_days", "aov", "max_delivery_delay_days", "customer_state", "no_such_feature")
N_BINS = 10
# Days whose telemetry is counted one by one.
COUNTED_DAYS = ("2001-07-01", "2001-07-02", "2001-07-03", "2001-07-04", "2001-07-05")

# A fixed pair of trees over recency and frequency: tree, node, weight, value, feature, threshold, yes, no.
TREES = [
    (0, 0, 1.0, 0.1, 0, 200.0, 1, 2),
    (0, 1, 1.0, -0.4, 1, 2.0, 3, 4),
    (0, 2, 1.0, 0.6, -1, None, -1, -1),
    (0, 3, 1.0, -0.1, -1, None, -1, -1),
    (0, 4, 1.0, -0.7, -1, None, -1, -1),
    (1, 0, 0.5, 0.02, 1, 5.0, 1, 2),
    (1, 1, 0.5, 0.2, -1, None, -1, -1),
    (1, 2, 0.5, -0.3, -1, None, -1, -1),
]
