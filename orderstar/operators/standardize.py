"""Standardisation of the four raw sources: typed casts, trimmed text, English column names.

A spec is a tuple of ``(output_name, raw_name, kind)``; ``kind`` is one of
``orderstar.functions.clean.KIND_TYPES``. The projection is a single ``select`` of built-in
expressions, so it stays inside whole-stage codegen and only the raw columns named in the spec are
read from parquet (column pruning reaches the scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstar.functions.clean import typed

Spec = Sequence[tuple[str, str, str]]

# Raw column names of the source files, and the standard names / types they map to.
CUSTOMER_SPEC: Spec = (
    ("customer_id", "customer_id", "int"),
    ("customer_name", "customer_name", "text"),
    ("channel", "canal", "text"),
    ("actual_segment", "segmento_actual", "text"),
    ("region", "region", "text"),
    ("comuna", "comuna", "text"),
    ("entry_date", "fecha_alta", "timestamp"),
    ("status", "estado", "text"),
    ("mix_credito_vs_contado_3m", "mix_credito_vs_contado_3m", "double"),
)

PRODUCT_SPEC: Spec = (
    ("product_id", "product_id", "int"),
    ("product_category", "product_category", "text"),
    ("product_sub_category", "sub_category", "text"),
    ("product_brand", "brand", "text"),
)

ORDER_HEADER_SPEC: Spec = (
    ("order_id", "order_id", "int"),
    ("customer_id", "customer_id", "int"),
    ("order_date", "order_date", "date"),
    ("channel", "canal", "text"),
    ("pay_type", "tipo_pago", "text"),
    ("flag_promo_pedido", "flag_promo_pedido", "int"),
    ("order_net_amount", "order_net_amount", "money"),
    ("order_gross_amount", "order_gross_amount", "money"),
    ("currency", "currency", "text"),
)

ORDER_LINE_SPEC: Spec = (
    ("order_id", "order_id", "int"),
    ("line_id", "line_id", "int"),
    ("product_id", "product_id", "int"),
    ("qty_units", "qty_units", "int"),
    ("unit_price", "unit_price", "money"),
    ("discount_amount", "discount_amount", "money"),
    ("promo_flag", "promo_flag", "int"),
    ("line_net_amount", "line_net_amount", "money"),
    ("order_net_amount_replicated", "order_net_amount_replicated", "money"),
)


def widen_ids(spec: Spec, id_type: str = "int") -> Spec:
    """``spec`` with its ``*_id`` columns of kind ``int`` read as ``id_type`` (``"bigint"`` for ids beyond INT)."""
    if id_type not in ("int", "bigint"):
        raise ValueError(f"id_type must be 'int' or 'bigint', not {id_type!r}")
    return tuple((out, raw, id_type if kind == "int" and out.endswith("_id") else kind) for out, raw, kind in spec)


def unparsed_key(spec: Spec, keys: Sequence[str]) -> Column:
    """TRUE where a raw value of a key column is present but does not parse (or does not fit its type)."""
    bad = F.lit(False)
    for out, raw, kind in spec:
        if out in keys:
            bad = bad | (F.col(raw).isNotNull() & typed(raw, kind).isNull())
    return bad


def parsed_rows(raw: DataFrame, spec: Spec, keys: Sequence[str]) -> DataFrame:
    """Raw rows whose keys parse (a missing key counts as parsed: it is NULL at the source)."""
    return raw.filter(~unparsed_key(spec, keys))


def rejected_rows(raw: DataFrame, spec: Spec, keys: Sequence[str]) -> DataFrame:
    """The raw rows that :func:`parsed_rows` leaves out, unchanged, for the reject table."""
    return raw.filter(unparsed_key(spec, keys))


def standardize(df: DataFrame, spec: Spec) -> DataFrame:
    """Project ``df`` through ``spec``: one typed, trimmed, renamed column per entry."""
    missing = [raw for _, raw, _ in spec if raw not in df.columns]
    if missing:
        raise ValueError(f"raw columns missing: {missing}")
    return df.select(*[typed(raw, kind).alias(out) for out, raw, kind in spec])


def standardize_customer(df: DataFrame, id_type: str = "int") -> DataFrame:
    return standardize(df, widen_ids(CUSTOMER_SPEC, id_type))


def standardize_product(df: DataFrame, id_type: str = "int") -> DataFrame:
    return standardize(df, widen_ids(PRODUCT_SPEC, id_type))


def standardize_order_header(df: DataFrame, id_type: str = "int") -> DataFrame:
    return standardize(df, widen_ids(ORDER_HEADER_SPEC, id_type))


def standardize_order_line(df: DataFrame, id_type: str = "int") -> DataFrame:
    return standardize(df, widen_ids(ORDER_LINE_SPEC, id_type))


#: Spec and dedupe key of each source.
SOURCES: dict[str, tuple[Spec, tuple[str, ...]]] = {
    "customer": (CUSTOMER_SPEC, ("customer_id",)),
    "product": (PRODUCT_SPEC, ("product_id",)),
    "orders_header": (ORDER_HEADER_SPEC, ("order_id",)),
    "orders_detail": (ORDER_LINE_SPEC, ("order_id", "line_id")),
}
