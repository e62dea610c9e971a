from marketframe.functions.columns import (
    safe_div,
    rolling_mean,
    rolling_std,
    rolling_guarded,
    pct_change,
    null_if_not_finite,
    corr_safe,
    r6,
)
from marketframe.functions import metrics

__all__ = [
    "safe_div",
    "rolling_mean",
    "rolling_std",
    "rolling_guarded",
    "pct_change",
    "null_if_not_finite",
    "corr_safe",
    "r6",
    "metrics",
]
