"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from orderstar.functions.calendar import (
    as_date_literal,
    as_timestamp_literal,
    calendar_attributes,
    window_start_period,
)
from orderstar.functions.clean import text, typed
from orderstar.functions.keys import (
    date_key,
    first_non_null,
    hash_key,
    key_or_default,
    period_key,
)
from orderstar.functions.metrics import conditional_amount, days_to_month_end, safe_ratio

__all__ = [
    "as_date_literal",
    "as_timestamp_literal",
    "calendar_attributes",
    "conditional_amount",
    "date_key",
    "days_to_month_end",
    "first_non_null",
    "hash_key",
    "key_or_default",
    "period_key",
    "safe_ratio",
    "text",
    "typed",
    "window_start_period",
]
