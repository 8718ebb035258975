"""Sources and sinks: CSV as strings, required columns, missing files, JSON documents,
JDBC options, versioned warehouse publish."""

import datetime as dt
import os

import pytest

from starloom.sources.csv import check_columns, read_csv
from starloom.sources.jdbc import jdbc_options
from starloom.sources.warehouse import current_version, publish_star, read_star


def test_csv_reads_strings_and_keeps_leading_zeros(spark, fixture_dir):
    df = read_csv(spark, f"{fixture_dir}/customers.csv", name="customers")
    assert all(t == "string" for c, t in df.dtypes if c != "_ord")
    zips = {r.customer_id: r.customer_zip_code_prefix for r in df.collect()}
    assert zips["k-ana"] == "470" and zips["k-caio"] == "8801234"
    assert "product_weight_g" in read_csv(spark, f"{fixture_dir}/products.csv", name="products").columns  # extras pass


def test_csv_doubled_quotes(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('product_id,product_category_name\n"p1","say ""hi"", ok"\n', encoding="utf-8")
    assert read_csv(spark, str(p), name="products").first()["product_category_name"] == 'say "hi", ok'


def test_missing_columns_listed(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("customer_id,city\nx,y\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Missing expected columns"):
        read_csv(spark, str(p), name="customers")
    with pytest.raises(ValueError, match=r"\[t\] Missing"):
        check_columns(spark.range(1), ["a"], "t")


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="orders"):
        read_csv(spark, str(tmp_path / "nope.csv"), name="orders")


def test_ingest_order_restores_file_order(spark, fixture_dir):
    df = read_csv(spark, f"{fixture_dir}/order_items.csv", name="order_items")
    ordered = [r.order_id for r in df.orderBy("_ord").collect()]
    assert ordered == ["r11", "r12", "r12", "r18", "r15", "r15", "r15", "r17", "r17", "r13"]


def test_jdbc_options_partitioned():
    o = jdbc_options("jdbc:x", "order_events", {"user": "u"}, "event_id", (1, 100), 4)
    assert o["partitionColumn"] == "event_id" and o["numPartitions"] == "4" and o["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")


def test_publish_versions(spark, raw, tmp_path):
    from starloom.params import Params
    from starloom.plans.star import load_star, transform

    root = str(tmp_path / "wh")
    assert current_version(spark, root) == 0
    assert read_star(spark, root)["fact_orders"].count() == 0
    staged = transform(raw, Params())
    star, _ = load_star(read_star(spark, root), staged, Params(), dt.datetime(2024, 1, 1))
    v, rows = publish_star(spark, root, star, dt.datetime(2024, 1, 1))
    assert v == 1 and rows["fact_orders"] == 5
    star2, rep = load_star(read_star(spark, root), staged, Params(), dt.datetime(2024, 1, 2))
    v2, rows2 = publish_star(spark, root, star2, dt.datetime(2024, 1, 2), new_facts=rep.inserted["fact_orders"])
    assert v2 == 2 and rows2 == rows
    assert read_star(spark, root)["fact_orders"].count() == 5
    assert read_star(spark, root, version=1)["fact_orders"].count() == 5
    with pytest.raises(ValueError, match="holds facts already"):
        publish_star(spark, root, star2, dt.datetime(2024, 1, 3))  # would load all facts again
    os.makedirs(f"{root}/v00000003/fact_orders")  # a crashed load without a commit record
    assert current_version(spark, root) == 2


def test_uncommitted_fact_partition_is_invisible_and_skipped(spark, raw, tmp_path):
    from pyspark.sql import functions as F

    from starloom.params import Params
    from starloom.plans.star import load_star, transform
    from starloom.sources.warehouse import _fact_table_name, fact_buckets_of

    root = str(tmp_path / "wh")
    staged = transform(raw, Params())
    star, _ = load_star(read_star(spark, root), staged, Params(), dt.datetime(2024, 1, 1))
    publish_star(spark, root, star, dt.datetime(2024, 1, 1))
    # A crashed load appended rows for version 2 but never committed.
    stale = read_star(spark, root)["fact_orders"].withColumn("load_version", F.lit(2))
    stale.write.insertInto(_fact_table_name(root, fact_buckets_of(spark, root)))
    assert read_star(spark, root)["fact_orders"].count() == 5
    star2, rep = load_star(read_star(spark, root), staged, Params(), dt.datetime(2024, 1, 2))
    v, rows = publish_star(spark, root, star2, dt.datetime(2024, 1, 2), new_facts=rep.inserted["fact_orders"])
    assert v == 3 and rows["fact_orders"] == 5
    assert read_star(spark, root)["fact_orders"].count() == 5


def test_existing_facts_are_not_shuffled_for_insert_once(spark, raw, tmp_path):
    from starloom.params import Params
    from starloom.plans.star import load_star, transform

    root = str(tmp_path / "wh")
    staged = transform(raw, Params())
    star, _ = load_star(read_star(spark, root), staged, Params(), dt.datetime(2024, 1, 1))
    publish_star(spark, root, star, dt.datetime(2024, 1, 1), fact_buckets=8)
    facts = read_star(spark, root)["fact_orders"]
    batch = staged.lines.select("order_id", "order_item_seq")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        anti = batch.join(facts.select("order_id", "order_item_seq"), ["order_id", "order_item_seq"], "left_anti")
        p = anti._jdf.queryExecution().executedPlan().toString()
        p0 = batch._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in p
    # The anti-join adds one exchange (the incoming batch); existing facts are read per bucket.
    assert p.count("Exchange hashpartitioning") == p0.count("Exchange hashpartitioning") + 1


def test_rebucketing_and_commit_keys(spark, raw, tmp_path):
    from starloom.params import Params
    from starloom.plans.star import load_star, transform
    from starloom.sources.warehouse import fact_buckets_of, max_keys, rebucket_facts

    root = str(tmp_path / "it's a warehouse")  # a quote in the path
    staged = transform(raw, Params())
    star, _ = load_star(None, staged, Params(), dt.datetime(2024, 1, 1))
    publish_star(spark, root, star, dt.datetime(2024, 1, 1), fact_buckets=3)
    before = sorted(map(tuple, read_star(spark, root)["fact_orders"].collect()))
    keys = max_keys(spark, root)
    assert keys["fact_orders"] == max(r[0] for r in before) and keys["dim_customer"] == 4
    assert rebucket_facts(spark, root, 5, dt.datetime(2024, 1, 2)) == 2 and fact_buckets_of(spark, root) == 5
    assert sorted(map(tuple, read_star(spark, root)["fact_orders"].collect())) == before
    assert read_star(spark, root, version=1)["fact_orders"].count() == 5
    star, rep = load_star(read_star(spark, root), staged, Params(), dt.datetime(2024, 1, 3), 5, max_keys(spark, root))
    _, rows = publish_star(spark, root, star, dt.datetime(2024, 1, 3), new_facts=rep.inserted["fact_orders"])
    assert rows["fact_orders"] == 5 and max_keys(spark, root) == keys


def test_json_lines_landing_round_trip(spark, raw, tmp_path):
    from starloom.sources.json_records import read_json_lines, record_counts, write_json_lines

    path = str(tmp_path / "api_jsonl")
    write_json_lines(raw.api_records, path)
    back = read_json_lines(spark, path)
    assert sorted(r["record"] for r in back.collect()) == sorted(r["record"] for r in raw.api_records.collect())
    r = record_counts(back).first()
    assert (r["records"], r["valid"], r["dropped"]) == (6, 5, 1)


def test_events_with_headers_left_join_and_order(spark):
    from starloom.sources.jdbc import events_with_headers

    events = spark.createDataFrame(
        [(2, "b", "shipped", "2017-01-05 10:00:00", "s1", None),
         (1, "b", "created", "2017-01-01 10:00:00", None, None),
         (3, "a", "created", "2017-02-01 10:00:00", None, "x")],
        "event_id long, order_id string, status string, event_timestamp string, seller_id string, notes string",
    )
    headers = spark.createDataFrame(
        [("b", "cust1", "2017-01-01", "2017-01-20", "web")],
        "order_id string, customer_id string, created_at string, expected_delivery string, channel string",
    )
    out = events_with_headers(events, headers, sort=True)
    assert out.columns == ["event_id", "order_id", "status", "event_timestamp", "seller_id", "notes",
                           "customer_id", "order_created_at", "expected_delivery", "channel"]
    rows = [(r.event_id, r.customer_id) for r in out.collect()]
    assert rows == [(3, None), (1, "cust1"), (2, "cust1")]  # ordered by order, time; no header -> nulls


def test_extract_order_events_logic_without_a_database(spark, monkeypatch):
    """The bounds query, the range-partitioned events read and the join, with the JDBC reads
    replaced by in-memory frames (no database is started)."""
    import starloom.sources.jdbc as jdbc

    calls = []
    events = spark.createDataFrame(
        [(2, "o1", "shipped", "2017-01-05 10:00:00", "s1", None), (1, "o1", "created", "2017-01-01 10:00:00", None, None),
         (5, "o9", "created", "2017-03-01 10:00:00", None, None)],
        "event_id long, order_id string, status string, event_timestamp string, seller_id string, notes string",
    )
    headers = spark.createDataFrame(
        [("o1", "c1", "2017-01-01", "2017-01-20", "web")],
        "order_id string, customer_id string, created_at string, expected_delivery string, channel string",
    )

    def fake_read(spark_, **kwargs):
        opts = jdbc.jdbc_options(**kwargs)
        calls.append(opts)
        if opts["dbtable"].startswith("(SELECT MIN(event_id)"):
            return spark_.createDataFrame([(1, 5)], "lo long, hi long")
        if opts["dbtable"].startswith("(SELECT MIN(created_at)"):
            return spark_.createDataFrame([("2017-01-01", "2017-02-01")], "lo string, hi string")
        return events if opts["dbtable"] == "order_events" else headers

    monkeypatch.setattr(jdbc, "read_jdbc", fake_read)
    out = jdbc.extract_order_events(spark, "jdbc:test", {"user": "u"}, num_partitions=4)
    assert sorted((r.event_id, r.customer_id) for r in out.collect()) == [(1, "c1"), (2, "c1"), (5, None)]
    options = {c["dbtable"]: c for c in calls}
    parts = lambda t: tuple(options[t][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions"))
    assert parts("order_events") == ("event_id", "1", "5", "4")
    assert parts("raw_orders") == ("created_at", "2017-01-01", "2017-02-01", "4")
    assert all(c["user"] == "u" for c in calls)


def test_database_extract_is_landed(spark, fixture_dir, tmp_path, monkeypatch):
    """The extract step with a database source, its reads substituted."""
    import starloom.sources.jdbc as jdbc
    from starloom.plans.pipeline import PipelineConfig, extract, load_raw

    events = spark.createDataFrame(
        [(9, "r12", "shipped", "2020-01-02 16:00:00", None, None), (10, "r12", "delivered", "2020-01-02 16:00:00", None, None)],
        "event_id long, order_id string, status string, event_timestamp string, seller_id string, notes string",
    )
    headers = spark.createDataFrame(
        [("r12", "k-bia", "2019-12-31", "2020-01-15", "app")],
        "order_id string, customer_id string, created_at string, expected_delivery string, channel string",
    )
    monkeypatch.setattr(jdbc, "column_bounds", lambda *a, **k: None)
    monkeypatch.setattr(jdbc, "read_jdbc", lambda s, **k: events if k["table"] == "order_events" else headers)
    names = ("customers", "orders", "order_items", "products")
    cfg = PipelineConfig(
        sources={n: f"{fixture_dir}/{n}.csv" for n in names},
        raw_root=str(tmp_path / "raw"),
        staging_root=str(tmp_path / "staging"),
        warehouse_root=str(tmp_path / "wh"),
        jdbc_url="jdbc:test",
    )
    counts = {}
    extract(spark, cfg, counts)
    assert counts["order_events"] == 2
    landed = load_raw(spark, cfg).order_events
    assert {(r.event_id, r.channel) for r in landed.collect()} == {(9, "app"), (10, "app")}
