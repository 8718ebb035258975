"""Registered queries over what a warehouse keeps between loads: rejects, logs of dimensions and of
status, key screens, measures of the gate, clustered landing and the whole pipeline through storage.

Registered as in :mod:`starloom.plans.catalog`. Tables a query writes go below the checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import infer_time_shapes, shape_timestamp
from starloom.frames import empty_frame
from starloom.operators.clean import clean_customers, clean_orders, parse_events
from starloom.operators.dedup import keep_first
from starloom.operators.facts import REJECT_COLUMNS, reason_counts, resolve_fact_keys_skewed, route_fact_lines, tag_fact_lines
from starloom.operators.gate import MEASURES_SCHEMA, incremental_quality_checks, load_measures
from starloom.operators.latest import STATUS_STATE_SCHEMA, latest_from_state, status_state
from starloom.operators.merge import latest_rows, scd1_delta
from starloom.operators.screen import key_bitmaps, screened_new_rows, slots_for
from starloom.plans import oracle as O
from starloom.plans import testdata as td
from starloom.plans.catalog import FACT_ROW_COLS, LINE_COLS, PARAMS, RUN1, RUN2, _early_order_ids, _raw, loaded_star, register
from starloom.plans.pipeline import PipelineConfig, run_pipeline
from starloom.plans.star import transform
from starloom.schemas import DIM_CUSTOMER, STAR_SCHEMAS
from starloom.session import cut_lineage, shared_folder
from starloom.sources.bucketed import bucketed_table
from starloom.sources.jdbc import events_with_headers
from starloom.sources.json_records import write_json_lines
from starloom.sources.layout import layout_report, write_clustered
from starloom.sources.warehouse import FACT, FACT_KEYS, LOAD_VERSION, _register_facts, committed_versions, fact_buckets_of, read_star

RUN3 = dt.datetime(2024, 1, 3)
BUCKETS = 8


# ----------------------------------------------------------------------------- one format a column

# Column name -> which values come first in the file it stands for, by the remainder of the order id.
_FILES = {
    "ts_plain": None,
    "ts_slashes": (11, 2),
    "ts_month_first": (11, 3),
    "ts_millis": (11, 4),
    "ts_zone": (11, 5),
    "ts_nanos": (11, 6),
    "ts_no_time": (101, 3),
}


def _first_sql(column: str, order: str) -> str:
    return f"(SELECT {column} FROM o_n WHERE {column} IS NOT NULL ORDER BY {order} LIMIT 1)"


def _inferred_sql() -> str:
    own = []
    for name, part in _FILES.items():
        order = "_ord" if part is None else f"_ord % {part[0]} <> {part[1]}, _ord"
        own.append(f"{O.inferred('order_purchase_timestamp', _first_sql('order_purchase_timestamp', order))} AS {name}")
    estimated = O.inferred("order_estimated_delivery_date", _first_sql("order_estimated_delivery_date", "_ord"))
    return f"SELECT order_id, {', '.join(own)}, {estimated} AS estimated_ts FROM o_n"


@register("timestamp_inferred", _inferred_sql())
def timestamp_inferred(spark, d):
    """The purchase time as a file would be read whose first row is of one kind or another."""
    o = _raw(spark, d).orders
    text = F.col("order_purchase_timestamp")
    columns = {n: (text, ["_ord"] if p is None else [F.col("_ord") % p[0] != p[1], "_ord"]) for n, p in _FILES.items()}
    columns["estimated_ts"] = (F.col("order_estimated_delivery_date"), ["_ord"])
    shapes = infer_time_shapes(o, columns)
    return o.select("order_id", *[shape_timestamp(columns[n][0], shapes[n], PARAMS.timestamp_formats).alias(n) for n in columns])


# ----------------------------------------------------------------------------- rejects

_REASON_SQL = """
, planted AS (SELECT order_id, order_item_seq, customer_id, product_id, date_key, order_status,
                     CASE WHEN order_item_seq % 6 = 5 THEN NULL ELSE price END AS price, freight_value FROM lines),
tagged AS (
  SELECT l.*, CASE WHEN c.customer_id IS NULL THEN 'customer' WHEN p.product_id IS NULL THEN 'product'
    WHEN l.date_key IS NULL THEN 'no_date' WHEN d.date_key IS NULL THEN 'date_not_in_dim'
    WHEN l.price IS NULL THEN 'price' END AS reason
  FROM planted l LEFT JOIN dim_customer c ON c.customer_id = l.customer_id
  LEFT JOIN (SELECT product_id FROM dim_product WHERE CAST(product_id AS BIGINT) % 19 <> 4) p ON p.product_id = l.product_id
  LEFT JOIN (SELECT date_key FROM dim_date WHERE date_key % 7 <> 3) d ON d.date_key = l.date_key)"""


def _tagged(spark, d) -> DataFrame:
    """Lines against a star that lacks some products and days; some lines have lost their price."""
    star, staged = loaded_star(spark, d)
    lines = staged.lines.withColumn("price", F.when(F.col("order_item_seq") % 6 != 5, F.col("price")))
    products = star["dim_product"].where(F.col("product_id").cast("bigint") % 19 != 4)
    days = star["dim_date"].where(F.col("date_key") % 7 != 3)
    return tag_fact_lines(lines, star["dim_customer"], products, days, star["dim_status"])


@register("fact_rejects", _REASON_SQL + f"SELECT {', '.join(REJECT_COLUMNS)} FROM tagged WHERE reason IS NOT NULL")
def fact_rejects(spark, d):
    return route_fact_lines(_tagged(spark, d)).rejects


@register(
    "fact_reject_counts",
    _REASON_SQL + "SELECT "
    "count(*) FILTER (WHERE reason IS NULL) AS accepted, count(*) FILTER (WHERE reason = 'customer') AS customer, "
    "count(*) FILTER (WHERE reason = 'product') AS product, count(*) FILTER (WHERE reason = 'no_date') AS no_date, "
    "count(*) FILTER (WHERE reason = 'date_not_in_dim') AS date_not_in_dim, count(*) FILTER (WHERE reason = 'price') AS price FROM tagged",
)
def fact_reject_counts(spark, d):
    return _tagged(spark, d).agg(*[c.alias(name) for name, c in reason_counts().items()])


# ----------------------------------------------------------------------------- skewed lookup

_HOT_CUSTOMER = "1"


@register(
    "fact_lookup_skewed",
    f"""
, hot AS (SELECT order_id, order_item_seq, CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '{_HOT_CUSTOMER}' ELSE customer_id END AS customer_id,
                 product_id, date_key, order_status, quantity, price, freight_value FROM lines)
SELECT l.order_id, l.order_item_seq, c.customer_key, p.product_key, l.date_key, s.status_key, l.quantity, l.price, l.freight_value
FROM hot l JOIN dim_customer c ON c.customer_id = l.customer_id JOIN dim_product p ON p.product_id = l.product_id
LEFT JOIN dim_status s ON s.status_label = l.order_status
WHERE l.date_key IN (SELECT date_key FROM dim_date) AND l.price IS NOT NULL""",
)
def fact_lookup_skewed(spark, d):
    """One customer holds a third of all lines."""
    star, staged = loaded_star(spark, d)
    dims = [star[d] for d in ("dim_customer", "dim_product", "dim_date", "dim_status")]
    rows = resolve_fact_keys_skewed(hot_lines(staged.lines), *dims, buckets=staged.buckets)
    return rows.select(*FACT_ROW_COLS)


def hot_lines(lines: DataFrame) -> DataFrame:
    own = F.when(F.col("order_id").cast("bigint") % 3 == 0, F.lit(_HOT_CUSTOMER)).otherwise(F.col("customer_id"))
    return lines.withColumn("customer_id", own)


# ----------------------------------------------------------------------------- dimension kept as a log

_SCD_LOG_SQL = f"""
, b AS (
  SELECT 1 AS v, customer_id, city, state, '00000' AS zip_code FROM customers_clean
    WHERE customer_id IN (SELECT customer_id FROM o_n WHERE _ord IN {O.EARLY})
  UNION ALL SELECT 2, customer_id, city, state, zip_code FROM customers_clean WHERE CAST(customer_id AS BIGINT) % 3 = 0
  UNION ALL SELECT 3, customer_id, city, 'ZZ', zip_code FROM customers_clean WHERE CAST(customer_id AS BIGINT) % 4 <> 1),
firsts AS (SELECT customer_id, min(v) AS first_load FROM b GROUP BY customer_id)
SELECT b.customer_id, city, state, zip_code, '2024-01-0' || v || ' 00:00:00' AS updated_at, CAST(first_load AS INTEGER) AS first_load,
       true AS above_earlier, (SELECT count(*) FROM firsts) AS distinct_keys
FROM b JOIN firsts f ON f.customer_id = b.customer_id
QUALIFY row_number() OVER (PARTITION BY b.customer_id ORDER BY v DESC) = 1"""


@register("scd1_log", _SCD_LOG_SQL)
def scd1_log(spark, d):
    """Three loads of customers into a bucketed log. Surrogate keys carry no order within a load: shown are
    the load each came from, that they lie above all earlier ones, and how many there are."""
    raw = _raw(spark, d)
    cc = cut_lineage(clean_customers(raw.customers), "customers")
    early = raw.orders.join(_early_order_ids(spark, d), "order_id", "left_semi").select("customer_id")
    number = F.col("customer_id").cast("bigint")
    batches = [
        cc.join(early, "customer_id", "left_semi").withColumn("zip_code", F.lit("00000")),
        cc.where(number % 3 == 0),
        cc.where(number % 4 != 1).withColumn("state", F.lit("ZZ")),
    ]
    log = bucketed_table(shared_folder(spark, "customer-log"), DIM_CUSTOMER, ["customer_id"], BUCKETS)
    start = 0
    for version, (batch, run_ts) in enumerate(zip(batches, (RUN1, RUN2, RUN3), strict=True), 1):
        rows = scd1_delta(
            log.read(spark), batch, "customer_id", ["city", "state", "zip_code"], "customer_key", run_ts, ["_ord"], BUCKETS, start
        )
        log.append(rows, version)
        start = log.read(spark).agg(F.coalesce(F.max("customer_key"), F.lit(0))).first()[0]
    rows = log.read(spark)
    first = rows.groupBy("customer_id").agg(F.min(LOAD_VERSION).alias("first_load"))
    current = latest_rows(rows, "customer_id").join(first, "customer_id")
    per_load = current.groupBy("first_load").agg(F.max("customer_key").alias("last"), F.countDistinct("customer_key").alias("n"))
    # Three rows: the largest key of earlier loads, and the number of keys.
    sums = {r["first_load"]: (r["last"], r["n"]) for r in per_load.collect()}
    below = F.coalesce(*[F.when(F.col("first_load") == v, F.lit(max([sums[w][0] for w in sums if w < v], default=0))) for v in sums], F.lit(0))
    return current.select(
        "customer_id",
        "city",
        "state",
        "zip_code",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
        "first_load",
        (F.col("customer_key") > below).alias("above_earlier"),
        F.lit(sum(n for _, n in sums.values())).cast("long").alias("distinct_keys"),
    )


# ----------------------------------------------------------------------------- latest status kept as state


@register("latest_status_incremental", "SELECT order_id, latest_event_status FROM latest")
def latest_status_incremental(spark, d):
    """Events in three loads that do not follow their times; each adds its own state to the log."""
    events = cut_lineage(parse_events(_raw(spark, d).order_events, PARAMS.timestamp_formats), "events")
    state = bucketed_table(shared_folder(spark, "status-state"), STATUS_STATE_SCHEMA, ["order_id"], BUCKETS)
    for version, part in enumerate((2, 0, 1), 1):
        state.append(status_state(events.where(F.pmod(F.col("event_id"), F.lit(3)) == part)), version)
    return latest_from_state(state.read(spark))


# ----------------------------------------------------------------------------- insert-once with a screen

_SCREEN_SQL = f"""
, u AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY order_id, order_item_seq ORDER BY _o, _p, _s, _d) = 1)
SELECT order_id, order_item_seq, product_id, price,
       CAST(CASE WHEN _o IN {O.EARLY} THEN 1 WHEN _o % 2 = 0 THEN 2 ELSE 3 END AS INTEGER) AS load_version FROM u"""


@register("append_screened", _SCREEN_SQL)
def append_screened(spark, d):
    """Three loads: early orders, then all even orders, then all. The first load's screen has too few bits
    on purpose, so many new keys hit it and are compared with its facts."""
    raw = _raw(spark, d)
    keys = list(FACT_KEYS)
    cols = ["order_id", "order_item_seq", "product_id", "price", "_ord"]
    lines = clean_orders(raw.orders, raw.order_items, raw.order_events, PARAMS).lines.select(*cols)
    lines = cut_lineage(keep_first(lines, keys, ["_ord"]), "lines")
    batches = [
        lines.join(_early_order_ids(spark, d), "order_id", "left_semi"),
        lines.where(F.col("order_id").cast("bigint") % 2 == 0),
        lines,
    ]
    facts = bucketed_table(shared_folder(spark, "facts"), "order_id string, order_item_seq long, product_id string, price double", keys, BUCKETS)
    screens = shared_folder(spark, "screens")
    screen = empty_frame(spark, key_bitmaps(lines, keys, 1).withColumn(LOAD_VERSION, F.lit(0)).schema)
    for version, batch in enumerate(batches, 1):
        new, _ = screened_new_rows(batch, facts.read(spark), screen, keys)
        facts.append(new, version)
        added = facts.read(spark, [version])
        slots = 1 if version == 1 else slots_for(added.count())
        key_bitmaps(added, keys, slots).write.parquet(f"{screens}/{LOAD_VERSION}={version}")
        screen = spark.read.parquet(screens)
    return facts.read(spark)


# ----------------------------------------------------------------------------- incremental gate


def _less_products_sql() -> str:
    counts = dict(O.CTES)["qc_counts"].replace("dim_product", "dim_product_less")
    checks = dict(O.CTES)["qc"].replace("qc_counts", "qc_counts_less")
    return f"""
, dim_product_less AS (SELECT * FROM dim_product WHERE CAST(product_id AS BIGINT) % 11 <> 5),
qc_counts_less AS ({counts}),
qc_less AS ({checks.replace("row_count_dim_product_less", "row_count_dim_product")})
SELECT seq, "check", status, detail, value, total FROM qc_less"""


@register("qc_incremental", _less_products_sql())
def qc_incremental(spark, d):
    """The gate from the measures of three loads, after some products were removed from their dimension."""
    star, staged = loaded_star(spark, d)
    folder = shared_folder(spark, "gate")
    facts = star["fact_orders"]
    for version in (1, 2, 3):
        added = facts.where(F.pmod(F.col("order_id").cast("bigint"), F.lit(3)) == version - 1)
        load_measures(added).write.parquet(f"{folder}/{LOAD_VERSION}={version}")
    measures = spark.read.schema(MEASURES_SCHEMA).parquet(folder)
    dims = {**star, "dim_product": star["dim_product"].where(F.col("product_id").cast("bigint") % 11 != 5)}
    return incremental_quality_checks(measures, dims, staged.lines, PARAMS)


# ----------------------------------------------------------------------------- clustered landing


@register(
    "events_layout",
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS unsorted_rows, CAST(0 AS BIGINT) AS overlapping_files FROM raw_events",
)
def events_layout(spark, d):
    """The database extract landed in its order: files of disjoint ranges, each sorted."""
    events = events_with_headers(td.order_events(spark, d), td.order_headers(spark, d), sort=False)
    by = ["order_id", "event_timestamp", "event_id"]
    path = write_clustered(events, shared_folder(spark, "events"), by, partitions=BUCKETS)
    return layout_report(spark, path, by).drop("files")


# ----------------------------------------------------------------------------- aliases


_ALIASES_SQL = """
, kept AS (SELECT customer_unique_id, arg_min(customer_id, _ord) AS survivor FROM c_n
           WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL GROUP BY customer_unique_id),
gone AS (SELECT c.customer_id AS alias, k.survivor FROM c_n c JOIN kept k ON k.customer_unique_id = c.customer_unique_id
         WHERE c.customer_id <> k.survivor AND c.customer_id NOT IN (SELECT survivor FROM kept))
SELECT l.order_id, l.order_item_seq, COALESCE(g.survivor, l.customer_id) AS customer_id, l.product_id, l.date_key, l.order_status,
       l.price, l.freight_value, l.quantity
FROM lines l LEFT JOIN gone g ON g.alias = l.customer_id"""


@register("order_facts_resolved", _ALIASES_SQL)
def order_facts_resolved(spark, d):
    return transform(_raw(spark, d), replace(PARAMS, resolve_aliases=True)).lines.select(*LINE_COLS)


# ----------------------------------------------------------------------------- the whole pipeline through storage


def write_sources(spark: SparkSession, d: str, root: str, early_only: bool, others: PipelineConfig | None = None) -> PipelineConfig:
    """The derived sources as the files a user has: gzipped CSV in input order, the catalog as JSON Lines.
    Only the orders differ between loads; the files of ``others``, written for another load, serve again."""
    orders = td.raw_orders(spark, d)
    if early_only:
        orders = orders.join(_early_order_ids(spark, d), "order_id", "left_semi")
    frames = {"orders": orders}
    if others is None:
        frames |= {
            "customers": td.raw_customers(spark, d),
            "order_items": td.raw_order_items(spark, d, placed=True),
            "products": td.raw_products(spark, d),
        }
    folder = f"{root}/sources-{'early' if early_only else 'all'}"
    for name, df in frames.items():
        ranged = df if name == "order_items" else df.repartitionByRange("_ord").sortWithinPartitions("_ord")
        ranged = ranged.drop("_ord")
        ranged.write.csv(
            f"{folder}/{name}", header=True, escape='"', compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if others is not None:
        return replace(others, sources={**others.sources, "orders": f"{folder}/orders"})
    td.order_events(spark, d).write.csv(f"{folder}/order_events", header=True, escape='"', compression="gzip")
    write_json_lines(td.api_records(spark, d), f"{folder}/catalog")
    return PipelineConfig(
        sources={name: f"{folder}/{name}" for name in frames},
        api_products=f"{folder}/catalog",
        api_format="lines",
        order_events=f"{folder}/order_events",
        raw_root=f"{root}/raw",
        staging_root=f"{root}/staging",
        warehouse_root=f"{root}/warehouse",
        report_root=f"{root}/reports",
        reject_root=f"{root}/rejects",
        gate_root=f"{root}/gate",
        fact_buckets=BUCKETS,
    )


def crash_after_facts(spark: SparkSession, root: str) -> None:
    """What a load leaves that died between its facts and its commit record: rows of the next version."""
    buckets = fact_buckets_of(spark, root)
    table = _register_facts(spark, root, buckets)
    version = max(committed_versions(spark, root)) + 1
    wrong = read_star(spark, root)[FACT].withColumn("price", F.lit(-1.0))
    wrong.withColumn(LOAD_VERSION, F.lit(version)).write.insertInto(table, overwrite=False)


_MONEY = "CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE)"


def _round_trip_sql() -> str:
    rows = []
    for load, own in ((1, f"WHERE _o IN {O.EARLY}"), (2, "")):
        dates = f"SELECT DISTINCT date_key FROM lines {own} {'AND' if own else 'WHERE'} date_key IS NOT NULL"
        rows += [
            f"SELECT {load} AS load_no, 'fact_orders' AS item, count(*) AS rows, {_MONEY} AS amount FROM fact_first {own}",
            f"SELECT {load}, 'dim_date', count(*), CAST(sum(date_key) AS DOUBLE) FROM ({dates})",
            f"SELECT {load}, 'dim_status', count(*), CAST(sum(status_key) AS DOUBLE) FROM dim_status",
            f"SELECT {load}, 'dim_customer', count(*), CAST(sum(length(city) + length(state) + length(zip_code)) AS DOUBLE) FROM dim_customer",
            f"SELECT {load}, 'dim_product', count(*), CAST(sum(length(category) + length(name)) AS DOUBLE) FROM dim_product",
            f"SELECT {load}, 'reject_' || reason, count(*), {_MONEY} FROM routed {own} {'AND' if own else 'WHERE'} reason IS NOT NULL GROUP BY reason",
        ]
    return (
        """
, routed AS (
  SELECT l.*, CASE WHEN c.customer_id IS NULL THEN 'customer' WHEN p.product_id IS NULL THEN 'product'
    WHEN l.date_key IS NULL THEN 'no_date' END AS reason
  FROM lines l LEFT JOIN dim_customer c ON c.customer_id = l.customer_id LEFT JOIN dim_product p ON p.product_id = l.product_id),
trip AS ("""
        + "\n  UNION ALL ".join(rows)
        + ")\nSELECT CAST(load_no AS INTEGER) AS load_no, item, rows, amount FROM trip"
    )


@register("pipeline_round_trip", _round_trip_sql())
def pipeline_round_trip(spark, d):
    """All four steps twice over files: early orders, a load that dies, then all orders. Each committed
    version is read back: rows and a sum of every table, and the rejects of its load by reason."""
    root = shared_folder(spark, "round-trip")
    first = write_sources(spark, d, root, early_only=True)
    results = [run_pipeline(spark, first, PARAMS, RUN1)]
    crash_after_facts(spark, f"{root}/warehouse")
    results.append(run_pipeline(spark, write_sources(spark, d, root, early_only=False, others=first), PARAMS, RUN2))
    amounts = {
        "dim_date": F.sum("date_key"),
        "dim_status": F.sum("status_key"),
        "dim_customer": F.sum(F.length("city") + F.length("state") + F.length("zip_code")),
        "dim_product": F.sum(F.length("category") + F.length("name")),
    }
    price = F.sum(F.col("price").cast("decimal(18,2)"))
    parts = []
    for load, result in enumerate(results, 1):
        star = read_star(spark, f"{root}/warehouse", result.version)
        for table in STAR_SCHEMAS:
            amount = price if table == FACT else amounts[table]
            parts.append(star[table].agg(F.count(F.lit(1)).alias("rows"), amount.cast("double").alias("amount")).select(F.lit(load).alias("load_no"), F.lit(table).alias("item"), "rows", "amount"))
        rejects = spark.read.parquet(f"{root}/rejects/load_version={result.version}")
        by_reason = rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), price.cast("double").alias("amount"))
        parts.append(by_reason.select(F.lit(load).alias("load_no"), F.concat(F.lit("reject_"), "reason").alias("item"), "rows", "amount"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
