"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from cohortflow.functions.numeric import avg_dec4, safe_ratio, to_dec4, within_tolerance
from cohortflow.functions.params import param_int, param_number, param_string, user_property
from cohortflow.functions.windows import cum_sum, revenue_metrics_columns, trailing_avg

__all__ = [
    "avg_dec4", "safe_ratio", "to_dec4", "within_tolerance",
    "param_int", "param_number", "param_string", "user_property",
    "cum_sum", "revenue_metrics_columns", "trailing_avg",
]
