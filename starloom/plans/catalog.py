"""Registered queries over the driver's tables, each paired with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library on whole tables;
``ORACLE[name]`` is the equivalent SQL over the same tables (see :mod:`starloom.plans.oracle`).
Column names match between the two; doubles that are means are rounded to 6 places on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.frames import empty_frame
from starloom.functions import date_key, lenient_double, lenient_int, lenient_timestamp, strip_ws, title_case, zfill
from starloom.operators.clean import (
    dim_date_from_lines,
    clean_customers,
    clean_orders,
    clean_product_category,
    clean_products,
    drop_null_keys,
    join_order_items,
    parse_events,
    parse_items,
    parse_order_times,
    rejected_status,
    valid_status,
)
from starloom.operators.counters import unpivot_counts
from starloom.operators.dedup import keep_first
from starloom.operators.enrich import api_enrichment, map_category
from starloom.operators.facts import resolve_fact_keys
from starloom.operators.keys import assign_surrogate_keys
from starloom.operators.latest import latest_status
from starloom.operators.merge import append_once, insert_new, scd1_merge
from starloom.operators.quality import quality_checks, report_lines, summary_counts
from starloom.params import Params
from starloom.plans import oracle as O
from starloom.plans import testdata as td
from starloom.plans.reports import revenue_by_month_category
from starloom.plans.star import load_star, materialize, stage, transform
from starloom.schemas import DIM_CUSTOMER, DIM_PRODUCT
from starloom.session import cut_lineage, sort_bounded
from starloom.sources.jdbc import events_with_headers
from starloom.sources.json_records import flatten_api_products, record_counts, validate_records

PARAMS = Params(valid_statuses=("F", "O"))
RUN1 = dt.datetime(2024, 1, 1)
RUN2 = dt.datetime(2024, 1, 2)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql)
        return fn

    return deco


def r6(c):
    return F.round(c, 6)


# ----------------------------------------------------------------------------- shared pieces


def _raw(spark, d):
    return td.raw_sources(spark, d)


def _orders_stages(spark, d):
    raw = _raw(spark, d)
    parsed = parse_order_times(raw.orders, PARAMS.timestamp_formats)
    keyed = drop_null_keys(parsed, ["order_id", "customer_id"])
    valid = valid_status(keyed, PARAMS.valid_statuses)
    joined = join_order_items(valid, parse_items(raw.order_items))
    priced = joined.where(F.col("price") > F.lit(PARAMS.min_price))
    return raw, parsed, keyed, valid, joined, priced


_STARS: dict[tuple, tuple] = {}


def loaded_star(spark: SparkSession, d: str):
    """Star loaded once per session and data folder (its keyed tables live in checkpoints)."""
    key = (spark.sparkContext.applicationId, id(spark), d)
    if key not in _STARS:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        staged = stage(transform(_raw(spark, d), PARAMS), buckets=buckets)
        star, _ = load_star(None, staged, PARAMS, RUN1)
        _STARS[key] = (materialize(star), staged)
    return _STARS[key]


# ----------------------------------------------------------------------------- scalar functions


@register(
    "na_tokens",
    "SELECT customer_id, customer_unique_id, customer_city, customer_state, customer_zip_code_prefix FROM c_n",
)
def na_tokens(spark, d):
    return _raw(spark, d).customers.drop("_ord")


@register(
    "lenient_numeric",
    "SELECT order_id, raw_item_id, product_id, price, freight_value FROM i_parsed",
)
def lenient_numeric(spark, d):
    items = _raw(spark, d).order_items
    return items.select(
        "order_id",
        F.col("order_item_id").alias("raw_item_id"),
        "product_id",
        lenient_double("price").alias("price"),
        lenient_double("freight_value", 0.0).alias("freight_value"),
    )


@register("seq_parse", "SELECT order_id, raw_item_id, order_item_id AS order_item_seq FROM i_parsed")
def seq_parse(spark, d):
    items = _raw(spark, d).order_items
    return items.select(
        "order_id", F.col("order_item_id").alias("raw_item_id"), lenient_int("order_item_id", 1).alias("order_item_seq")
    )


@register("lenient_timestamp", "SELECT order_id, purchase_ts, estimated_ts FROM o_parsed")
def lenient_timestamp_q(spark, d):
    o = _raw(spark, d).orders
    return o.select(
        "order_id",
        lenient_timestamp("order_purchase_timestamp", PARAMS.timestamp_formats).alias("purchase_ts"),
        lenient_timestamp("order_estimated_delivery_date", PARAMS.timestamp_formats).alias("estimated_ts"),
    )


@register(
    "title_case",
    f"SELECT 'city' AS kind, customer_id AS id, {O.title(O.strip('customer_city'))} AS cased FROM c_n "
    f"UNION ALL SELECT 'priority', order_id, {O.title('o_orderpriority')} FROM o_n",
)
def title_case_q(spark, d):
    raw = _raw(spark, d)
    cities = raw.customers.select(
        F.lit("city").alias("kind"), F.col("customer_id").alias("id"), title_case(strip_ws("customer_city")).alias("cased")
    )
    priorities = raw.orders.select(
        F.lit("priority").alias("kind"), F.col("order_id").alias("id"), title_case("o_orderpriority").alias("cased")
    )
    return cities.unionByName(priorities)


@register(
    "strip_upper_lower",
    f"SELECT customer_id, {O.strip('customer_city')} AS city_stripped, upper({O.strip('customer_state')}) AS state, "
    f"lower({O.strip('customer_city')}) AS city_lower FROM c_n",
)
def strip_upper_lower(spark, d):
    c = _raw(spark, d).customers
    return c.select(
        "customer_id",
        strip_ws("customer_city").alias("city_stripped"),
        F.upper(strip_ws("customer_state")).alias("state"),
        F.lower(strip_ws("customer_city")).alias("city_lower"),
    )


@register(
    "zero_pad",
    f"SELECT customer_id, COALESCE({O.zfill5(O.strip('customer_zip_code_prefix'))}, '00000') AS zip_code FROM c_n",
)
def zero_pad(spark, d):
    c = _raw(spark, d).customers
    return c.select(
        "customer_id", F.coalesce(zfill(strip_ws("customer_zip_code_prefix"), 5), F.lit("00000")).alias("zip_code")
    )


# ----------------------------------------------------------------------------- dates


@register("date_key", "SELECT order_id, CAST(strftime(purchase_ts, '%Y%m%d') AS INTEGER) AS date_key FROM o_parsed")
def date_key_q(spark, d):
    o = parse_order_times(_raw(spark, d).orders, PARAMS.timestamp_formats)
    return o.select("order_id", date_key("order_purchase_timestamp").alias("date_key"))


@register("dim_date", "SELECT * FROM dim_date ORDER BY date_key")
def dim_date_q(spark, d):
    raw = _raw(spark, d)
    return sort_bounded(clean_orders(raw.orders, raw.order_items, None, PARAMS).dim_date, "date_key")


# ----------------------------------------------------------------------------- filters


@register("drop_null_keys", "SELECT order_id, customer_id FROM o_keys")
def drop_null_keys_q(spark, d):
    return _orders_stages(spark, d)[2].select("order_id", "customer_id")


@register("valid_status", "SELECT order_id, order_status FROM o_valid")
def valid_status_q(spark, d):
    return _orders_stages(spark, d)[3].select("order_id", "order_status")


@register(
    "rejected_status",
    f"SELECT order_status, count(*) AS rows FROM o_keys WHERE NOT COALESCE(order_status IN {O.VALID}, false) "
    "GROUP BY order_status",
)
def rejected_status_q(spark, d):
    return rejected_status(_orders_stages(spark, d)[2], PARAMS.valid_statuses)


@register("positive_price", "SELECT order_id, order_item_id AS order_item_seq, product_id, price FROM priced")
def positive_price(spark, d):
    return _orders_stages(spark, d)[5].select(
        "order_id", F.col("order_item_id").alias("order_item_seq"), "product_id", "price"
    )


# ----------------------------------------------------------------------------- dedup, joins, latest


@register("dedup_first", "SELECT customer_unique_id, customer_id FROM customers_clean")
def dedup_first(spark, d):
    c = drop_null_keys(_raw(spark, d).customers, ["customer_id", "customer_unique_id"])
    return keep_first(c, ["customer_unique_id"], ["_ord"]).select("customer_unique_id", "customer_id")


LINE_COLS = (
    "order_id",
    "order_item_seq",
    "customer_id",
    "product_id",
    "date_key",
    "order_status",
    "price",
    "freight_value",
    "quantity",
)


@register("order_lines", "SELECT " + ", ".join(LINE_COLS) + " FROM lines0")
def order_lines(spark, d):
    raw = _raw(spark, d)
    return clean_orders(raw.orders, raw.order_items, None, PARAMS).lines.select(*LINE_COLS)


@register(
    "events_with_headers",
    """SELECT e.event_id, e.order_id, e.status, e.event_timestamp, e.seller_id, e.notes, h.customer_id,
  h.created_at AS order_created_at, h.expected_delivery, h.channel
FROM raw_events e LEFT JOIN headers h ON h.order_id = e.order_id ORDER BY e.order_id, e.event_timestamp""",
)
def events_with_headers_q(spark, d):
    return events_with_headers(td.order_events(spark, d), td.order_headers(spark, d))


@register("latest_status", "SELECT order_id, latest_event_status FROM latest")
def latest_status_q(spark, d):
    ev = parse_events(_raw(spark, d).order_events, PARAMS.timestamp_formats)
    return latest_status(ev)


@register("status_override", "SELECT order_id, order_item_seq, product_id, order_status FROM lines")
def status_override(spark, d):
    raw = _raw(spark, d)
    lines = clean_orders(raw.orders, raw.order_items, raw.order_events, PARAMS).lines
    return lines.select("order_id", "order_item_seq", "product_id", "order_status")


# ----------------------------------------------------------------------------- products and catalog


@register("category_map", "SELECT product_id, category, name FROM p_mapped")
def category_map(spark, d):
    p = clean_product_category(_raw(spark, d).products)
    return p.select(
        "product_id", F.col("product_category_name").alias("category"), map_category(F.col("product_category_name")).alias("name")
    )


def _enrichment(spark, d):
    return api_enrichment(flatten_api_products(validate_records(_raw(spark, d).api_records)))


@register(
    "category_enrichment",
    "SELECT api_category, round(avg_price, 6) AS avg_price, round(avg_rating, 6) AS avg_rating FROM enrich",
)
def category_enrichment(spark, d):
    e = _enrichment(spark, d)
    return e.select("api_category", r6(F.col("avg_price")).alias("avg_price"), r6(F.col("avg_rating")).alias("avg_rating"))


@register(
    "product_dim",
    "SELECT product_id, category, name, round(api_price, 6) AS api_price, round(api_rating, 6) AS api_rating "
    "FROM products_clean",
)
def product_dim(spark, d):
    p = clean_products(_raw(spark, d).products, _enrichment(spark, d))
    return p.select(
        "product_id", "category", "name", r6(F.col("api_price")).alias("api_price"), r6(F.col("api_rating")).alias("api_rating")
    )


@register(
    "json_required_keys",
    "SELECT count(*) AS records, count(*) FILTER (WHERE valid) AS valid, count(*) FILTER (WHERE NOT valid) AS dropped "
    "FROM api_all",
)
def json_required_keys(spark, d):
    return record_counts(_raw(spark, d).api_records)


@register("json_flatten", "SELECT id, api_category, price, rating FROM api")
def json_flatten(spark, d):
    flat = flatten_api_products(validate_records(_raw(spark, d).api_records))
    return flat.select(F.col("id").cast("long").alias("id"), "api_category", "price", "rating")


# ----------------------------------------------------------------------------- pipelines


@register("customer_dim", "SELECT customer_id, customer_unique_id, city, state, zip_code FROM customers_clean")
def customer_dim(spark, d):
    return clean_customers(_raw(spark, d).customers).drop("_ord")


@register("order_facts", "SELECT " + ", ".join(LINE_COLS) + " FROM lines")
def order_facts(spark, d):
    raw = _raw(spark, d)
    return clean_orders(raw.orders, raw.order_items, raw.order_events, PARAMS).lines.select(*LINE_COLS)


# ----------------------------------------------------------------------------- merges and keys (two loads)


def _early_order_ids(spark, d) -> DataFrame:
    o = td.table(spark, d, "orders")
    return o.where(o.o_orderdate < F.lit(td.FIRST_LOAD_BEFORE).cast("timestamp_ntz")).select(
        F.col("o_orderkey").cast("string").alias("order_id")
    )


_SCD_SQL = f"""
, b1 AS (SELECT customer_id, city, state, '00000' AS zip_code, _ord FROM customers_clean
         WHERE customer_id IN (SELECT customer_id FROM o_n WHERE _ord IN {O.EARLY})),
b2 AS (SELECT customer_id, city, state, zip_code, _ord FROM customers_clean),
t1 AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, city, state, zip_code,
              {O.RUN1} AS updated_at FROM b1),
merged AS (
  SELECT t1.customer_key, t1.customer_id,
         CASE WHEN b2.customer_id IS NOT NULL THEN b2.city ELSE t1.city END AS city,
         CASE WHEN b2.customer_id IS NOT NULL THEN b2.state ELSE t1.state END AS state,
         CASE WHEN b2.customer_id IS NOT NULL THEN b2.zip_code ELSE t1.zip_code END AS zip_code,
         CASE WHEN b2.customer_id IS NOT NULL THEN {O.RUN2} ELSE t1.updated_at END AS updated_at
  FROM t1 LEFT JOIN b2 ON b2.customer_id = t1.customer_id
  UNION ALL
  SELECT (SELECT max(customer_key) FROM t1) + row_number() OVER (ORDER BY customer_id), customer_id, city, state,
         zip_code, {O.RUN2}
  FROM b2 WHERE customer_id NOT IN (SELECT customer_id FROM t1))
SELECT customer_key, customer_id, city, state, zip_code, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM merged"""


@register("scd1_merge", _SCD_SQL)
def scd1_merge_q(spark, d):
    raw = _raw(spark, d)
    cc = cut_lineage(clean_customers(raw.customers), "customers")
    # The first load saw the customers of early orders, with other zip codes; the second sees all.
    early = raw.orders.join(_early_order_ids(spark, d), "order_id", "left_semi").select("customer_id")
    b1 = cc.join(early, "customer_id", "left_semi").withColumn("zip_code", F.lit("00000"))
    b2 = cc
    attrs = ["city", "state", "zip_code"]
    empty = empty_frame(spark, DIM_CUSTOMER)
    t1, _ = scd1_merge(empty, b1, "customer_id", attrs, "customer_key", RUN1, ["_ord"])
    t2, _ = scd1_merge(t1, b2, "customer_id", attrs, "customer_key", RUN2, ["_ord"])
    return t2.select(
        "customer_key", "customer_id", *attrs, F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at")
    )


@register("insert_new", "SELECT * FROM dim_date")
def insert_new_q(spark, d):
    raw = _raw(spark, d)
    # Both loads read the same staged lines; the first saw only orders placed before the cut.
    lines = cut_lineage(clean_orders(raw.orders, raw.order_items, None, PARAMS).lines, "lines")
    first = lines.join(_early_order_ids(spark, d), "order_id", "left_semi")
    out, _ = insert_new(dim_date_from_lines(first), dim_date_from_lines(lines), ["date_key"])
    return out


_APPEND_SQL = f"""
, f1 AS (SELECT * FROM lines WHERE _o IN {O.EARLY}
         QUALIFY row_number() OVER (PARTITION BY order_id, order_item_seq ORDER BY _o, _p, _s, _d) = 1),
f2 AS (SELECT * FROM lines
       QUALIFY row_number() OVER (PARTITION BY order_id, order_item_seq ORDER BY _o, _p, _s, _d) = 1),
n2 AS (SELECT f2.* FROM f2 LEFT JOIN f1 ON f1.order_id = f2.order_id AND f1.order_item_seq = f2.order_item_seq
       WHERE f1.order_id IS NULL),
both_loads AS (SELECT *, 1 AS load_no FROM f1 UNION ALL SELECT *, 2 FROM n2)
SELECT order_id, order_item_seq, product_id, price, load_no, load_no = 2 AS above_first_load,
       (SELECT count(*) FROM both_loads) AS distinct_ids FROM both_loads"""


@register("append_once", _APPEND_SQL)
def append_once_q(spark, d):
    """Two loads. Surrogate keys carry no order: shown are their number (they are unique) and that
    those of the second load are larger than all of the first."""
    raw = _raw(spark, d)
    cols = ["order_id", "order_item_seq", "product_id", "price", "_ord"]
    l2 = cut_lineage(clean_orders(raw.orders, raw.order_items, raw.order_events, PARAMS).lines.select(*cols), "lines")
    l1 = l2.join(_early_order_ids(spark, d), "order_id", "left_semi")
    empty = empty_frame(
        spark,
        T._parse_datatype_string(
            "fact_id long, order_id string, order_item_seq long, product_id string, price double, loaded_at timestamp"
        ),
    )
    t1, _ = append_once(empty, l1, ["order_id", "order_item_seq"], ["_ord"], "fact_id", RUN1)
    t1 = cut_lineage(t1, "facts-1")
    t2, _ = append_once(t1, l2, ["order_id", "order_item_seq"], ["_ord"], "fact_id", RUN2)
    t2 = cut_lineage(t2, "facts-2")
    load_no = F.when(F.col("loaded_at") == F.lit(RUN1).cast("timestamp"), 1).otherwise(2)
    ids = t2.agg(F.countDistinct("fact_id").alias("distinct_ids"), F.max(F.when(load_no == 1, F.col("fact_id"))).alias("_last"))
    return t2.crossJoin(F.broadcast(ids)).select(  # one row of two numbers
        "order_id",
        "order_item_seq",
        "product_id",
        "price",
        load_no.alias("load_no"),
        (F.col("fact_id") > F.coalesce("_last", F.lit(0))).alias("above_first_load"),
        "distinct_ids",
    )


@register("surrogate_keys", "SELECT customer_key, customer_id FROM dim_customer")
def surrogate_keys(spark, d):
    c = clean_customers(_raw(spark, d).customers)
    return assign_surrogate_keys(c.select("customer_id"), "customer_key", ["customer_id"]).select(
        "customer_key", "customer_id"
    )


_INCR_SQL = f"""
, p1 AS (SELECT * FROM products_clean WHERE product_id IN (
           SELECT product_id FROM i_n WHERE order_id IN (
             SELECT CAST(o_orderkey AS VARCHAR) FROM orders
             WHERE o_orderdate < TIMESTAMP '{td.FIRST_LOAD_BEFORE} 00:00:00'))),
t1 AS (SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id FROM p1)
SELECT product_key, product_id FROM t1
UNION ALL
SELECT (SELECT COALESCE(max(product_key), 0) FROM t1) + row_number() OVER (ORDER BY product_id), product_id
FROM products_clean WHERE product_id NOT IN (SELECT product_id FROM t1)"""


@register("surrogate_keys_incremental", _INCR_SQL)
def surrogate_keys_incremental(spark, d):
    raw = _raw(spark, d)
    products = cut_lineage(clean_products(raw.products, _enrichment(spark, d)), "products")
    early_products = raw.order_items.join(_early_order_ids(spark, d), "order_id", "left_semi").select("product_id")
    p1 = products.join(early_products, "product_id", "left_semi")
    attrs = ["category", "name", "api_price", "api_rating"]
    empty = empty_frame(spark, DIM_PRODUCT)
    t1, _ = scd1_merge(empty, p1, "product_id", attrs, "product_key", RUN1, ["_ord"])
    t2, _ = scd1_merge(t1, products, "product_id", attrs, "product_key", RUN2, ["_ord"])
    return t2.select("product_key", "product_id")


# ----------------------------------------------------------------------------- load and quality


FACT_ROW_COLS = (
    "order_id",
    "order_item_seq",
    "customer_key",
    "product_key",
    "date_key",
    "status_key",
    "quantity",
    "price",
    "freight_value",
)


@register("fact_lookup", "SELECT " + ", ".join(FACT_ROW_COLS) + " FROM fact_rows")
def fact_lookup(spark, d):
    star, staged = loaded_star(spark, d)
    dims = [star[d] for d in ("dim_customer", "dim_product", "dim_date", "dim_status")]
    rows = resolve_fact_keys(staged.lines, *dims, buckets=staged.buckets)
    return rows.select(*FACT_ROW_COLS)


def _qc(spark, d) -> DataFrame:
    star, staged = loaded_star(spark, d)
    return quality_checks(star, staged.lines, PARAMS)


_QC_COLS = 'seq, "check", status, detail, value, total'


@register("qc_row_counts", f"SELECT {_QC_COLS} FROM qc WHERE seq BETWEEN 1 AND 5")
def qc_row_counts(spark, d):
    return _qc(spark, d).where(F.col("seq").between(1, 5))


@register("qc_fact_columns", f"SELECT {_QC_COLS} FROM qc WHERE seq BETWEEN 6 AND 9")
def qc_fact_columns(spark, d):
    return _qc(spark, d).where(F.col("seq").between(6, 9))


@register("qc_orphans", f"SELECT {_QC_COLS} FROM qc WHERE seq BETWEEN 10 AND 13")
def qc_orphans(spark, d):
    return _qc(spark, d).where(F.col("seq").between(10, 13))


@register("qc_load_ratio", f"SELECT {_QC_COLS} FROM qc WHERE seq = 14")
def qc_load_ratio(spark, d):
    return _qc(spark, d).where(F.col("seq") == 14)


_BAD_SQL = """
, bad AS (SELECT fact_orders.*, CASE WHEN order_item_seq % 4 = 0 THEN NULL ELSE customer_key END AS ck,
                 CASE WHEN order_item_seq % 5 = 0 THEN -1 ELSE product_key END AS pk FROM fact_orders),
n AS (SELECT count(*) AS total, count(*) FILTER (WHERE ck IS NULL) AS nulls,
             count(*) FILTER (WHERE pk = -1) AS orphans FROM bad)
SELECT 6 AS seq, 'null_fk_customer_key' AS "check", CASE WHEN nulls > 0.01 * total THEN 'FAIL' ELSE 'PASS' END AS status,
       nulls AS value, total FROM n
UNION ALL SELECT 11, 'orphan_fk_product_key', CASE WHEN orphans > 0 THEN 'FAIL' ELSE 'PASS' END, orphans, orphans FROM n"""


@register("qc_orphans_and_nulls", _BAD_SQL)
def qc_orphans_and_nulls(spark, d):
    """The gate over facts with planted null customer keys and unknown product keys."""
    star, staged = loaded_star(spark, d)
    seq = F.col("order_item_seq")
    bad = star["fact_orders"].withColumns(
        {
            "customer_key": F.when(seq % 4 != 0, F.col("customer_key")),
            "product_key": F.when(seq % 5 == 0, F.lit(-1).cast("long")).otherwise(F.col("product_key")),
        }
    )
    checks = quality_checks({**star, "fact_orders": bad}, staged.lines, PARAMS)
    return checks.where(F.col("seq").isin(6, 11)).select("seq", "check", "status", "value", "total")


@register(
    "qc_summary",
    "SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS failures, "
    "count(*) FILTER (WHERE status = 'WARN') AS warnings FROM qc",
)
def qc_summary(spark, d):
    return summary_counts(_qc(spark, d))


@register(
    "qc_report_lines",
    """SELECT seq, printf('  [%-4s] %s  %-30s  %s', status,
         CASE status WHEN 'PASS' THEN '✓' WHEN 'WARN' THEN '⚠' ELSE '✗' END, "check", detail) AS line FROM qc
UNION ALL
SELECT 100, printf('  Total: %d checks | %d FAILED | %d WARNINGS', count(*),
       count(*) FILTER (WHERE status = 'FAIL'), count(*) FILTER (WHERE status = 'WARN')) FROM qc""",
)
def qc_report_lines(spark, d):
    return report_lines(_qc(spark, d))


@register(
    "step_counters",
    f"""SELECT 'customers_raw' AS step, count(*) AS rows FROM c_n
UNION ALL SELECT 'customers_keys', count(*) FROM c_n WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL
UNION ALL SELECT 'customers_clean', count(*) FROM customers_clean
UNION ALL SELECT 'orders_raw', count(*) FROM o_n
UNION ALL SELECT 'orders_keys', count(*) FROM o_keys
UNION ALL SELECT 'orders_valid', count(*) FROM o_valid
UNION ALL SELECT 'items_raw', count(*) FROM i_n
UNION ALL SELECT 'lines_joined', count(*) FROM joined
UNION ALL SELECT 'lines_priced', count(*) FROM priced
UNION ALL SELECT 'lines_event_status', count(*) FROM lines0 l JOIN latest t ON t.order_id = l.order_id
UNION ALL SELECT 'products_raw', count(*) FROM p_n
UNION ALL SELECT 'products_clean', count(*) FROM products_clean
UNION ALL SELECT 'api_records', count(*) FROM api_all
UNION ALL SELECT 'api_valid', count(*) FROM api
UNION ALL SELECT 'total_raw', (SELECT count(*) FROM c_n) + (SELECT count(*) FROM o_n) + (SELECT count(*) FROM i_n)
                              + (SELECT count(*) FROM p_n)""",
)
def step_counters(spark, d):
    """One aggregate of conditional counts a source, one more over the order lines' join."""
    raw, parsed, keyed, valid, joined, priced = _orders_stages(spark, d)
    latest = latest_status(parse_events(raw.order_events, PARAMS.timestamp_formats))
    rows = F.count(F.lit(1))
    c_keys = F.col("customer_id").isNotNull() & F.col("customer_unique_id").isNotNull()
    customers = raw.customers.agg(
        rows.alias("customers_raw"),
        F.count_if(c_keys).alias("customers_keys"),
        F.countDistinct(F.when(c_keys, F.col("customer_unique_id"))).alias("customers_clean"),
    )
    o_keys = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
    allowed = F.col("order_status").isin(*PARAMS.valid_statuses)
    orders = raw.orders.agg(
        rows.alias("orders_raw"), F.count_if(o_keys).alias("orders_keys"), F.count_if(o_keys & allowed).alias("orders_valid")
    )
    good = F.col("price") > F.lit(PARAMS.min_price)
    lines = joined.join(latest, "order_id", "left").agg(
        rows.alias("lines_joined"),
        F.count_if(good).alias("lines_priced"),
        F.count_if(good & F.col("latest_event_status").isNotNull()).alias("lines_event_status"),
    )
    items = raw.order_items.agg(rows.alias("items_raw"))
    products = raw.products.agg(rows.alias("products_raw"), F.countDistinct("product_id").alias("products_clean"))
    catalog = record_counts(raw.api_records).select(F.col("records").alias("api_records"), F.col("valid").alias("api_valid"))
    counts = [unpivot_counts(x) for x in (customers, orders, items, lines, products, catalog)]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    out = cut_lineage(out, "step-counts")  # 14 rows, so the total does not run the sources again
    total = out.where(F.col("step").isin("customers_raw", "orders_raw", "items_raw", "products_raw"))
    return out.unionByName(total.agg(F.lit("total_raw").alias("step"), F.sum("rows").cast("long").alias("rows")))


# ----------------------------------------------------------------------------- flagship


@register(
    "star_revenue",
    """SELECT d.year, d.month, p.name AS category, CAST(sum(CAST(f.price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  count(*) AS lines, CAST(sum(f.quantity) AS BIGINT) AS units
FROM fact_orders f JOIN dim_date d ON d.date_key = f.date_key JOIN dim_product p ON p.product_key = f.product_key
GROUP BY d.year, d.month, p.name""",
)
def star_revenue(spark, d):
    star, _ = loaded_star(spark, d)
    return revenue_by_month_category(star)
