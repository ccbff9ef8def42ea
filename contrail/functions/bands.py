"""Status bands of dashboard values.

A value at or above a step takes that step's colour, as panel thresholds do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: panel thresholds (warn, alert) ----------------------------
REQUEST_RATE_STEPS = (10.0, 50.0)      # requests per second
LATENCY_P95_STEPS = (0.1, 0.5)         # seconds
ERROR_SHARE_STEPS = (0.01, 0.05)       # share of requests


def band(value: Column | str, warn: float, alert: float,
         labels: tuple[str, str, str] = ("green", "yellow", "red")) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(v >= F.lit(alert), labels[2])
        .when(v >= F.lit(warn), labels[1])
        .otherwise(labels[0])
    )
