"""Cleaning transforms on hand-built fixtures; expected rows derived by hand."""


import pytest
from pyspark.sql import functions as F

from starloom.operators.clean import clean_customers, clean_orders, clean_products, rejected_status
from starloom.operators.enrich import api_enrichment
from starloom.operators.latest import latest_status
from starloom.operators.clean import parse_events
from starloom.params import Params
from starloom.sources.json_records import flatten_api_products, validate_records


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_customers_golden(raw):
    out = clean_customers(raw.customers)
    assert rows(out, "customer_id", "customer_unique_id", "city", "state", "zip_code") == [
        ("k-ana", "p-1", "Vila D'Água-Fria", "BA", "00470"),
        ("k-bia", "p-2", "João-De-Barro", "PE", "55002"),
        ("k-caio", "p-3", "Três Lagos", "XX", "8801234"),
        ("k-eva", "p-4", "Unknown", "CE", "+0007"),
    ]


def test_customer_dedup_keeps_first_in_input_order(raw):
    out = clean_customers(raw.customers)
    assert out.where(F.col("customer_unique_id") == "p-1").select("customer_id").first()[0] == "k-ana"


LINE = ("order_id", "order_item_seq", "customer_id", "product_id", "date_key", "order_status", "price", "freight_value", "quantity")


def test_order_lines_without_events(raw):
    out = clean_orders(raw.orders, raw.order_items, None, Params())
    assert rows(out.lines, *LINE) == [
        ("r11", 1, "k-ana", "s-lamp", 20190407, "delivered", 41.75, 3.1, 1),
        ("r12", 1, "k-bia", "s-rug", 20191231, "invoiced", 260.4, 31.05, 1),
        ("r12", 2, "k-bia", "s-shirt", 20191231, "invoiced", 18.99, 2.45, 1),
        ("r13", 1, "k-ana2", "s-kite", 20200229, "shipped", 12.0, 0.0, 1),  # hexadecimal is no number
        ("r15", 1, "k-caio", "s-ring", 20200816, "approved", 77.07, 9.99, 1),
        ("r15", 1, "k-caio", "s-toy", 20200816, "approved", 6.3, 0.0, 1),
        ("r15", 3000000000, "k-caio", "s-toy", 20200816, "approved", 6.35, 1.0, 1),  # beyond 32 bits
        ("r17", 1, "k-eva", "s-rug", None, "unavailable", 33.33, 0.0, 1),
    ]
    # r14 has no customer, r16 no allowed status, r18 no positive price, a line of r17 no price.


def test_dim_date_only_dates_seen(raw):
    out = clean_orders(raw.orders, raw.order_items, None, Params())
    assert rows(out.dim_date, "date_key", "full_date", "year", "month", "day", "quarter", "weekday") == [
        (20190407, "2019-04-07", 2019, 4, 7, 2, "Sunday"),
        (20191231, "2019-12-31", 2019, 12, 31, 4, "Tuesday"),
        (20200229, "2020-02-29", 2020, 2, 29, 1, "Saturday"),
        (20200816, "2020-08-16", 2020, 8, 16, 3, "Sunday"),
    ]


def test_rejected_status_counts_null_too(spark):
    df = spark.createDataFrame([("a", "ok"), ("b", None), ("c", "bad"), ("d", "bad")], "order_id string, order_status string")
    got = {tuple(r) for r in rejected_status(df, ["ok"]).collect()}
    assert got == {(None, 1), ("bad", 2)}


def test_latest_status_rules(raw):
    ev = parse_events(raw.order_events, Params().timestamp_formats)
    got = dict(rows(latest_status(ev), "order_id", "latest_event_status"))
    assert got["r11"] == "held"  # a later event with a null status does not erase it
    assert got["r12"] == "delivered"  # equal times: event 10 is above event 9, though ids come as text
    assert got["r15"] == "shipped"  # unparseable time sorts last and wins


def test_event_status_overrides_after_validation(raw):
    out = clean_orders(raw.orders, raw.order_items, raw.order_events, Params())
    status = dict(rows(out.lines, "order_id", "order_status"))
    assert status == {
        "r11": "held",  # not an allowed status, still applied
        "r12": "delivered",
        "r13": "shipped",  # no events: unchanged
        "r15": "shipped",
        "r17": "unavailable",
    }


def test_products_with_catalog(raw):
    enrichment = api_enrichment(flatten_api_products(validate_records(raw.api_records)))
    out = clean_products(raw.products, enrichment)
    got = [(a, b, c, round(d, 6), round(e, 6)) for a, b, c, d, e in rows(out, "product_id", "category", "name", "api_price", "api_rating")]
    assert got == [
        ("s-kite", "pipas", "electronics", 50.0, 3.0),
        ("s-lamp", "audio", "electronics", 50.0, 3.0),
        ("s-ring", "relogios_presentes", "jewelery", 75.0, 0.75),
        ("s-rug", "cama_mesa_banho", "women's clothing", 64.0, 3.25),
        ("s-shirt", "fashion_roupa_masculina", "men's clothing", 0.0, 0.0),  # no catalog record of the label
        ("s-toy", "uncategorized", "electronics", 50.0, 3.0),
    ]


def test_products_without_catalog_get_zeros(raw):
    out = clean_products(raw.products, None)
    assert {(r.api_price, r.api_rating) for r in out.collect()} == {(0.0, 0.0)}
    assert out.count() == 6


def test_catalog_validation_by_key_presence(raw):
    valid = validate_records(raw.api_records)
    assert valid.count() == 5  # record 26 lacks keys; a present null price passes
    flat = dict((r.id, (r.price, r.rating)) for r in flatten_api_products(valid).collect())
    assert flat["24"] == (150.0, 0.0)  # rating not an object
    assert flat["25"] == (0.0, 1.5)  # price present but null


def test_top_level_must_be_an_array(spark, tmp_path):
    from starloom.sources.json_records import read_json_array

    p = tmp_path / "bad.json"
    p.write_text('{"id": 1}')
    with pytest.raises(Exception, match="Expected a JSON array"):
        read_json_array(spark, str(p)).collect()
