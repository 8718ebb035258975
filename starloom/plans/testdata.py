"""Map the driver's TPC-H-style tables onto the pipeline's source roles.

Every derived column is a Spark expression over the whole table, so the work grows with the data.
The derivations plant the cases the pipeline must handle (missing-value markers, bad numbers,
mixed timestamp formats, padded and mixed-case text, duplicate customer aliases, null keys,
unknown statuses, unparseable event times, catalog records with missing keys). The same
derivations are written in DuckDB SQL in :mod:`starloom.plans.oracle`.

Roles: customers <- customer, orders <- orders, order_items <- lineitem, products <- part,
catalog records <- part, order events <- events (user_id as the order id), order headers <- orders.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.csv import normalize_na
from starloom.sources.json_records import records_from_array_documents

# Orders placed before this day form the first of two loads in the incremental queries.
FIRST_LOAD_BEFORE = "1998-01-01"


_SCANS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table; the base relation is reused within a session (no repeated listing)."""
    key = (spark.sparkContext.applicationId, id(spark), f"{sf_dir}/{name}.parquet")
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(key[2])
    return _SCANS[key]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        """CASE WHEN c_custkey % 97 = 13 THEN 'NA'
                WHEN c_custkey % 10 = 9 THEN CAST(c_custkey - 1 AS STRING)
                ELSE CAST(c_custkey AS STRING) END AS customer_unique_id""",
        """CASE WHEN c_custkey % 31 = 0 THEN 'N/A'
                WHEN c_custkey % 4 = 0 THEN concat('  ', lower(c_mktsegment), ' city\t')
                WHEN c_custkey % 4 = 1 THEN concat(lower(c_mktsegment), '-', lower(c_name))
                WHEN c_custkey % 4 = 2 THEN concat('santa ', lower(c_mktsegment), ' d''oeste')
                ELSE concat(upper(c_mktsegment), ' embu-guaçu') END AS customer_city""",
        """CASE WHEN c_custkey % 23 = 0 THEN ''
                ELSE concat(' ', lower(substr(c_mktsegment, 1, 2)), ' ') END AS customer_state""",
        """CASE WHEN c_custkey % 29 = 0 THEN 'null'
                WHEN c_custkey % 11 = 0 THEN CAST(c_custkey * 1000 + 123456 AS STRING)
                WHEN c_acctbal < 0 THEN concat('-', CAST(c_nationkey AS STRING))
                ELSE CAST(c_nationkey * 100 + c_custkey % 100 AS STRING) END AS customer_zip_code_prefix""",
        "c_custkey AS _ord",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn(
        "_t", F.expr("timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), o_orderdate)")
    )
    return o.selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "CASE WHEN o_orderkey % 211 = 5 THEN NULL ELSE CAST(o_custkey AS STRING) END AS customer_id",
        "CASE WHEN o_orderkey % 199 = 7 THEN 'null' ELSE o_orderstatus END AS order_status",
        """CASE WHEN o_orderkey % 101 = 3 THEN 'not a date'
                WHEN o_orderkey % 103 = 4 THEN 'NaN'
                WHEN o_orderkey % 11 = 2 THEN date_format(_t, 'yyyy/MM/dd HH:mm:ss')
                WHEN o_orderkey % 11 = 3 THEN date_format(_t, 'MM/dd/yyyy')
                WHEN o_orderkey % 11 = 4 THEN concat(date_format(_t, 'yyyy-MM-dd''T''HH:mm:ss'), '.123')
                WHEN o_orderkey % 11 = 5 THEN concat(date_format(_t, 'yyyy-MM-dd''T''HH:mm:ss'), 'Z')
                WHEN o_orderkey % 11 = 6 THEN concat(date_format(_t, 'yyyy-MM-dd HH:mm:ss'), '.123456789')
                WHEN o_orderkey % 5 = 0 THEN date_format(_t, 'yyyy-MM-dd')
                WHEN o_orderkey % 5 = 1 THEN date_format(_t, 'yyyy-MM-dd''T''HH:mm:ss')
                ELSE date_format(_t, 'yyyy-MM-dd HH:mm:ss') END AS order_purchase_timestamp""",
        "concat(' ', date_format(timestampadd(DAY, 14, o_orderdate), 'yyyy-MM-dd HH:mm:ss')) AS order_estimated_delivery_date",
        "o_orderpriority",
        "o_orderkey AS _ord",
    )


def raw_order_items(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """With ``placed`` in input order, file by file: the narrow columns move, texts are made afterwards."""
    li = table(spark, sf_dir, "lineitem")
    if placed:
        order = ["l_partkey", "l_suppkey", "l_shipdate"]
        li = li.repartitionByRange(*order).sortWithinPartitions(*order)
    return li.selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        """CASE WHEN l_partkey % 53 = 0 THEN 'x'
                WHEN l_partkey % 59 = 0 THEN concat(CAST(l_linenumber AS STRING), '.7')
                WHEN l_partkey % 61 = 0 THEN 'NA'
                WHEN l_partkey % 67 = 0 THEN CAST(l_linenumber + 3000000000 AS STRING)
                ELSE CAST(l_linenumber AS STRING) END AS order_item_id""",
        "CAST(l_partkey AS STRING) AS product_id",
        """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '0.00'
                WHEN l_suppkey % 41 = 0 THEN 'NaN'
                WHEN l_suppkey % 43 = 0 THEN '1,000'
                WHEN l_suppkey % 47 = 0 THEN '-5'
                ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS price""",
        """CASE WHEN l_partkey % 7 = 0 THEN 'n/a'
                WHEN l_partkey % 11 = 0 THEN '1e1'
                WHEN l_partkey % 13 = 0 THEN '1d'
                WHEN l_partkey % 17 = 0 THEN '2.5f'
                WHEN l_partkey % 19 = 0 THEN '0x1p3'
                ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS STRING) END AS freight_value""",
        "named_struct('partkey', l_partkey, 'suppkey', l_suppkey, 'shipdate', l_shipdate) AS _ord",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        """CASE WHEN p_partkey % 53 = 0 THEN NULL
                WHEN p_type = 'STANDARD' THEN 'eletronicos'
                WHEN p_type = 'LARGE' THEN '  Fashion_Roupa_Feminina '
                WHEN p_type = 'MEDIUM' THEN 'joias_relogios'
                WHEN p_type = 'ECONOMY' THEN 'FASHION_CALCADOS'
                ELSE lower(p_type) END AS product_category_name""",
        "p_partkey AS _ord",
    )


def api_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product catalog as JSON array documents of at most 20 records each (like API pages)."""
    p = table(spark, sf_dir, "part")
    rec = p.selectExpr(
        "p_partkey DIV 20 AS page",
        """CASE WHEN p_partkey % 41 = 0
                  THEN to_json(named_struct('id', p_partkey, 'title', p_name))
                WHEN p_partkey % 43 = 0
                  THEN to_json(named_struct('id', p_partkey, 'title', p_name, 'price', p_retailprice,
                                            'category', 'electronics', 'rating', 'n/a'))
                WHEN p_partkey % 47 = 0
                  THEN to_json(named_struct('id', p_partkey, 'title', p_name, 'price', CAST(NULL AS DOUBLE),
                                            'category', 'jewelery',
                                            'rating', named_struct('rate', p_size / 10.0, 'count', p_size)),
                               map('ignoreNullFields', 'false'))
                ELSE to_json(named_struct('id', p_partkey, 'title', p_name, 'price', p_retailprice,
                                          'category', CASE p_size % 4 WHEN 0 THEN 'electronics'
                                                                      WHEN 1 THEN 'Jewelery'
                                                                      WHEN 2 THEN 'men''s clothing'
                                                                      ELSE 'WOMEN''S CLOTHING' END,
                                          'rating', named_struct('rate', p_size / 10.0, 'count', p_size)))
           END AS record""",
    )
    # Part keys are unique, so a page holds at most 20 records whatever the table size.
    docs = rec.groupBy("page").agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list("record")), F.lit("]")).alias("value")
    )
    return docs.select("value")


def api_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from_array_documents(api_documents(spark, sf_dir))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.selectExpr(
        "CAST(event_id AS STRING) AS event_id",  # text, as it comes from a CSV extract
        "CAST(user_id AS STRING) AS order_id",
        """CASE event_type WHEN 'purchase' THEN 'F' WHEN 'click' THEN 'O' WHEN 'error' THEN NULL
                ELSE event_type END AS status""",
        """CASE WHEN event_id % 97 = 0 THEN 'garbage'
                WHEN event_id % 2 = 0 THEN '2024-06-01 00:00:00'  -- ties, decided by the id
                ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS event_timestamp""",
        "concat('seller', CAST(event_id % 13 AS STRING)) AS seller_id",
        "CASE WHEN event_type = 'error' THEN 'error event' END AS notes",
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        "o_orderdate AS created_at",
        "timestampadd(DAY, 14, o_orderdate) AS expected_delivery",
        "CASE o_orderkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END AS channel",
    )


class TestSources:
    """The six sources, each built on first use (missing-value markers normalised as a CSV reader
    would). Attributes match :class:`starloom.plans.star.RawSources` and may be reassigned."""

    def __init__(self, spark: SparkSession, sf_dir: str, with_events: bool = True, with_api: bool = True):
        self._spark, self._dir, self._events, self._api = spark, sf_dir, with_events, with_api

    @cached_property
    def customers(self) -> DataFrame:
        return normalize_na(raw_customers(self._spark, self._dir))

    @cached_property
    def orders(self) -> DataFrame:
        return normalize_na(raw_orders(self._spark, self._dir))

    @cached_property
    def order_items(self) -> DataFrame:
        return normalize_na(raw_order_items(self._spark, self._dir))

    @cached_property
    def products(self) -> DataFrame:
        return normalize_na(raw_products(self._spark, self._dir))

    @cached_property
    def api_records(self) -> DataFrame | None:
        return api_records(self._spark, self._dir) if self._api else None

    @cached_property
    def order_events(self) -> DataFrame | None:
        return normalize_na(order_events(self._spark, self._dir)) if self._events else None


def raw_sources(spark: SparkSession, sf_dir: str, with_events: bool = True, with_api: bool = True) -> TestSources:
    """All sources of the driver's tables, built lazily."""
    return TestSources(spark, sf_dir, with_events, with_api)
