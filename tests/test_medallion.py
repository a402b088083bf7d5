"""The bronze -> silver -> gold run on a landing zone laid out as the original expects: single
``customers.csv`` / ``products.csv`` files and ``*orders_header*`` / ``*orders_detail*`` files at several
depths, next to files that must not be picked up. Expected gold values are worked out by hand."""

from __future__ import annotations

import csv
import datetime as dt
import os

import pytest

from orderstar.operators.features import FeatureParams
from orderstar.plans.medallion import run_medallion
from orderstar.sources.files import read_parquet
from tests.test_operators import CUSTOMER_COLS, HEADER_COLS, LINE_COLS, PRODUCT_COLS


def _csv(path, cols, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(cols)
        w.writerows(data)


def _landing_zone(raw):
    _csv(f"{raw}/customers.csv", CUSTOMER_COLS, [
        (1, "Ana", "tradicional", "A", "RM", "Stgo", "2020-01-01 08:00:00", "activo", ""),
        (1, "Ana old", "moderno", "A", "RM", "Stgo", "2019-01-01 08:00:00", "activo", ""),  # older copy
        (2, "Beto", "moderno", "A", "V", "Vina", "2020-01-01 08:00:00", "activo", ""),
        (3, "Caro", "tradicional", "B", "V", "Vina", "2020-01-01 08:00:00", "activo", ""),
    ])
    _csv(f"{raw}/products.csv", PRODUCT_COLS, [(1, "c1", "s1", "b1"), (2, "c2", "s2", "b2")])
    _csv(f"{raw}/2001/06/orders_header_a.csv", HEADER_COLS, [
        (10, 1, "2001-06-05", "tradicional", "credito", 1, "100.00", "100.00", "CLP"),
        (11, 1, "2001-07-05", "tradicional", "contado", 0, "30.00", "30.00", "CLP"),
    ])
    _csv(f"{raw}/orders_header_b.csv", HEADER_COLS, [
        (12, 2, "2001-07-10", "moderno", "credito", 0, "10.00", "10.00", "CLP"),
        (13, 3, "2001-07-20", "tradicional", "credito", 0, "25.00", "25.00", "CLP"),
    ])
    _csv(f"{raw}/2001/notes.csv", ["x"], [("not an order file",)])
    _csv(f"{raw}/2001/orders_detail_x.csv", LINE_COLS, [
        (10, 1, 1, 1, "60.00", "0", 1, "60.00", "100.00"),
        (10, 2, 2, 1, "40.00", "0", 0, "40.00", "100.00"),
        (11, 1, 1, 1, "30.00", "0", 0, "30.00", "30.00"),
    ])
    _csv(f"{raw}/2001/07/08/orders_detail_y.csv", LINE_COLS, [
        (12, 1, 1, 1, "10.00", "0", 0, "10.00", "10.00"),
        (13, 1, 2, 1, "25.00", "0", 0, "25.00", "25.00"),
    ])


def test_medallion_original_layout(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    _landing_zone(raw)
    params = FeatureParams(as_of="2001-08-01")  # default channel 'tradicional', credit type 'credito'
    res = run_medallion(spark, raw, tmp_root, params, now=dt.datetime(2001, 8, 1, 12, 0))
    gold = {r["customer_id"]: r.asDict() for r in res.gold.collect()}
    assert sorted(gold) == [1, 3]
    c1, c3 = gold[1], gold[3]
    assert (c1["recencia_dias"], float(c1["ventas_total_3m"]), c1["frecuencia_pedidos_3m"]) == (57, 130.0, 2)
    assert float(c1["ticket_promedio_3m"]) == 65.0 and c1["dias_promedio_entre_pedidos"] == 30.0
    assert c1["variedad_categorias_3m"] == 2 and float(c1["porcentaje_pedidos_promo_3m"]) == 0.5
    assert float(c1["mix_credito_vs_contado_3m"]) == pytest.approx(100 / 130)
    assert (c3["recencia_dias"], c3["frecuencia_pedidos_3m"], c3["dias_promedio_entre_pedidos"]) == (42, 1, None)
    assert float(c3["mix_credito_vs_contado_3m"]) == 1.0 and float(c3["porcentaje_pedidos_promo_3m"]) == 0.0

    bronze_headers = read_parquet(spark, res.paths["orders_header"])
    assert bronze_headers.count() == 4  # both header files, any depth; notes.csv skipped
    assert {os.path.basename(r["source_file"]) for r in bronze_headers.collect()} == {
        "orders_header_a.csv", "orders_header_b.csv"}
    assert read_parquet(spark, res.paths["orders_detail"]).count() == 5
    dim = read_parquet(spark, res.paths["dim_customer"])
    assert dim.count() == 4  # three customers + unknown member
    fact = read_parquet(spark, res.paths["fact_order_line"])
    assert sorted(int(d.split("=")[1]) for d in os.listdir(res.paths["fact_order_line"]) if d.startswith("period=")) == [
        200106, 200107]
    assert fact.count() == 5
    for name, report in res.reports.items():
        assert all(r["ok"] for r in report.collect()), name


def test_run_fails_before_silver_when_keys_are_lost(spark, tmp_root):
    from orderstar.operators.quality import QualityError

    raw = f"{tmp_root}/raw"
    _landing_zone(raw)
    _csv(f"{raw}/2001/orders_detail_bad.csv", LINE_COLS, [("A7", 1, 1, 1, "1.00", "0", 0, "1.00", "1.00"), (3_000_000_000, 1, 1, 1, "1.00", "0", 0, "1.00", "1.00")])
    params = FeatureParams(as_of="2001-08-01")
    with pytest.raises(QualityError, match="casts_orders_detail"):
        run_medallion(spark, raw, f"{tmp_root}/a", params, now=dt.datetime(2001, 8, 1, 12, 0))
    assert not os.path.exists(f"{tmp_root}/a/silver")
    res = run_medallion(spark, raw, f"{tmp_root}/b", params, now=dt.datetime(2001, 8, 1, 12, 0), max_rejects=2, profile_tables=True)
    assert read_parquet(spark, f"{tmp_root}/b/silver/rejects/orders_detail").count() == 2
    assert {"fact_order_line_write", "dim_date_write", "gold_write", "order_headers_write"} <= set(res.reports)
    assert read_parquet(spark, f"{tmp_root}/b/profiles/customer_features").count() > 5
