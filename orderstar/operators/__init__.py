"""DataFrame -> DataFrame operators."""

from orderstar.operators.dedupe import keep_first, latest_per_key
from orderstar.operators.dimensions import (
    CUSTOMER_UNKNOWN,
    PRODUCT_UNKNOWN,
    bounded_calendar,
    calendar_range_from,
    dim_customer,
    dim_date,
    dim_product,
    union_unknown_member,
)
from orderstar.operators.facts import (
    enriched_headers,
    fact_order,
    fact_order_line,
    join_line_header,
    latest_order_headers,
    latest_order_lines,
    positive_line_filter,
)
from orderstar.operators.features import (
    FeatureParams,
    channel_window_filter,
    customer_features,
    customer_sales,
    distinct_orders,
    order_lag,
)
from orderstar.operators.merge import upsert, upsert_parquet
from orderstar.operators.standardize import (
    standardize,
    standardize_customer,
    standardize_order_header,
    standardize_order_line,
    standardize_product,
)

__all__ = [
    "CUSTOMER_UNKNOWN",
    "PRODUCT_UNKNOWN",
    "FeatureParams",
    "bounded_calendar",
    "calendar_range_from",
    "channel_window_filter",
    "customer_features",
    "customer_sales",
    "dim_customer",
    "dim_date",
    "dim_product",
    "distinct_orders",
    "enriched_headers",
    "fact_order",
    "fact_order_line",
    "join_line_header",
    "keep_first",
    "latest_order_headers",
    "latest_order_lines",
    "latest_per_key",
    "order_lag",
    "positive_line_filter",
    "standardize",
    "standardize_customer",
    "standardize_order_header",
    "standardize_order_line",
    "standardize_product",
    "union_unknown_member",
    "upsert",
    "upsert_parquet",
]
