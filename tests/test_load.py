"""Star load: upserts keep surrogate keys, facts are insert-once, reruns add nothing."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.params import Params
from starloom.plans.star import load_star, materialize, transform

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 1, 2)


def counts(star):
    return {k: v.count() for k, v in star.items()}


def test_load_counts_and_keys(raw):
    staged = transform(raw, Params())
    star, report = load_star(None, staged, Params(), T1)
    star = materialize(star)
    assert counts(star) == {"dim_date": 4, "dim_status": 8, "dim_customer": 4, "dim_product": 6, "fact_orders": 5}
    status = {r.status_label: r.status_key for r in star["dim_status"].collect()}
    assert status["delivered"] == 1 and status["created"] == 8  # list order
    cust = {r.customer_id: r.customer_key for r in star["dim_customer"].collect()}
    assert cust == {"k-ana": 1, "k-bia": 2, "k-caio": 3, "k-eva": 4}
    facts = sorted(
        (r.order_id, r.order_item_seq, r.customer_key, r.product_key, r.date_key, r.status_key, r.price)
        for r in star["fact_orders"].collect()
    )
    assert facts == [
        ("r11", 1, 1, 2, 20190407, None, 41.75),  # unknown event status -> null status key, kept
        ("r12", 1, 2, 4, 20191231, 1, 260.4),
        ("r12", 2, 2, 5, 20191231, 1, 18.99),
        ("r15", 1, 3, 3, 20200816, 2, 77.07),  # duplicate (r15, 1): first staged row wins
        ("r15", 3000000000, 3, 6, 20200816, 2, 6.35),  # a sequence beyond 32 bits is a fact of its own
    ]
    # r17 (null purchase date) and r13 (customer alias dropped by dedup) are skipped at load.
    ids = [r.fact_id for r in star["fact_orders"].collect()]
    assert len(set(ids)) == 5 and min(ids) >= 1


def test_lines_without_a_date_row_or_with_nulls(raw):
    """A fact's date must be in the dimension; null attributes load as defaults."""
    staged = transform(raw, Params())
    days = staged.dim_date.where(F.col("date_key") != 20191231)
    nulls = staged.customers.withColumn("city", F.lit(None).cast("string"))
    bare = staged.products.withColumn("api_price", F.lit(None).cast("double")).withColumn("name", F.lit(None).cast("string"))
    lines = staged.lines.withColumn("freight_value", F.lit(None).cast("double")).withColumn("quantity", F.lit(None).cast("int"))
    star, _ = load_star(None, staged._replace(dim_date=days, customers=nulls, products=bare, lines=lines), Params(), T1)
    star = materialize(star)
    assert {r.order_id for r in star["fact_orders"].collect()} == {"r11", "r15"}
    assert {r.city for r in star["dim_customer"].collect()} == {""}
    assert {(r.name, r.api_price) for r in star["dim_product"].collect()} == {("", 0.0)}
    assert {(r.freight_value, r.quantity) for r in star["fact_orders"].collect()} == {(0.0, 1)}


def test_without_an_ordinal_reruns_agree(raw):
    staged = transform(raw, Params())
    shuffled = [staged._replace(lines=staged.lines.drop("_ord").repartition(n)) for n in (1, 3, 7)]
    got = [
        sorted((r.order_id, r.order_item_seq, r.price) for r in load_star(None, s, Params(), T1)[0]["fact_orders"].collect())
        for s in shuffled
    ]
    assert got[0] == got[1] == got[2] and len(got[0]) == 5


def test_new_facts_are_shuffled_once(raw, spark):
    """Removing duplicates, the anti join, keys and a bucketed write share one hash partitioning."""
    from starloom.frames import empty_frame
    from starloom.operators.merge import append_once
    from starloom.schemas import FACT_ORDERS
    from starloom.session import cut_lineage

    lines = cut_lineage(
        transform(raw, Params()).lines.select(
            "order_id", "order_item_seq", *[F.lit(1).cast("long").alias(c) for c in ("customer_key", "product_key", "status_key")],
            "date_key", "quantity", "price", "freight_value",
        ),
        "t-lines",
    )
    empty = empty_frame(spark, FACT_ORDERS)
    _, new = append_once(empty, lines, ["order_id", "order_item_seq"], [F.col("price")], "fact_id", T1, partitions=16, start=7)
    placed = new.repartition(16, "order_id", "order_item_seq")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == 1
    ids = [r.fact_id for r in new.collect()]
    assert len(set(ids)) == len(ids) == 7 and min(ids) > 7


def test_rerun_changes_nothing_but_updated_at(raw):
    staged = transform(raw, Params())
    s1, _ = load_star(None, staged, Params(), T1)
    s1 = materialize(s1)
    s2, rep = load_star(s1, staged, Params(), T2)
    s2 = materialize(s2)
    assert counts(s2) == counts(s1)
    assert rep.inserted["fact_orders"].count() == 0
    key = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
    assert key(s2["dim_customer"], "customer_key", "customer_id", "city") == key(s1["dim_customer"], "customer_key", "customer_id", "city")
    assert {r[0] for r in s2["dim_customer"].select("updated_at").collect()} == {T2}


def test_scd1_overwrites_and_adds_with_new_keys(raw, spark):
    staged = transform(raw, Params())
    s1, _ = load_star(None, staged, Params(), T1)
    s1 = materialize(s1)
    moved = staged.customers.withColumn(
        "city", F.when(F.col("customer_id") == "k-ana", F.lit("Nova Vila")).otherwise(F.col("city"))
    )
    extra = spark.createDataFrame([("k-new", "p-9", "Porto Novo", "RN", "59000")], "customer_id string, customer_unique_id string, city string, state string, zip_code string")
    staged2 = staged._replace(customers=moved.drop("_ord").unionByName(extra))
    s2, rep = load_star(s1, staged2, Params(), T2)
    got = {r.customer_id: (r.customer_key, r.city) for r in s2["dim_customer"].collect()}
    assert got["k-ana"] == (1, "Nova Vila")
    assert got["k-new"] == (5, "Porto Novo")


def test_facts_first_wins_across_batches(raw, spark):
    staged = transform(raw, Params())
    s1, _ = load_star(None, staged, Params(), T1)
    s1 = materialize(s1)
    changed = staged.lines.withColumn("price", F.col("price") + 1)
    s2, rep = load_star(s1, staged._replace(lines=changed), Params(), T2)
    before = {(r.order_id, r.order_item_seq): r.price for r in s1["fact_orders"].collect()}
    after = {(r.order_id, r.order_item_seq): r.price for r in s2["fact_orders"].collect()}
    assert before == after
