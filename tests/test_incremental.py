"""What is kept between loads: rejects, logs, states, screens, measures, clustered files; and time formats
taken from a column's first value. Results are compared with SQL in test_oracle; here are the traps and
the plans."""

import datetime as dt
import re
import warnings
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.functions import infer_time_shapes, shape_timestamp, time_shape
from starloom.operators.clean import clean_orders, customer_aliases, parse_events
from starloom.operators.facts import REJECT_REASONS, reason_counts, resolve_fact_keys, resolve_fact_keys_skewed, route_fact_lines, tag_fact_lines
from starloom.operators.gate import incremental_quality_checks, load_measures, merged_measures
from starloom.operators.latest import STATUS_STATE_SCHEMA, latest_from_state, latest_status, status_state
from starloom.operators.lookup import heavy_hitters, lookup_skewed
from starloom.operators.merge import latest_rows, scd1_delta, scd1_merge
from starloom.operators.quality import quality_checks
from starloom.operators.screen import SLOT_BITS, key_bitmaps, screened, screened_new_rows, slots_for
from starloom.params import Params
from starloom.plans.pipeline import PipelineConfig, run_pipeline
from starloom.plans.star import load_star, materialize, stage, transform
from starloom.schemas import DIM_CUSTOMER
from starloom.session import cut_lineage
from starloom.sources.bucketed import bucketed_table
from starloom.sources.layout import layout_report, write_clustered
from starloom.sources.warehouse import read_star

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def quiet(spark):
    """No adaptive changes and no broadcast of one's own accord: the plan is what the code asks for."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


# ----------------------------------------------------------------------------- one format a column

FIRSTS = [
    "2019-04-07 08:15:09", "2019-04-07", "2019/04/07 09:00:00", "04/07/2020", "16/08/2020", "2019-12-31T23:59:59.999", "2019-4-7",
    "2019-04-07 08:15", "1/2/2020 10:00", "16/08/2020 10:00:00", "2020/8/16", "2019-04-07 8:15:09", "20190407", "12-31-2019",
    " 2019-04-07 08:15:09",
]
OTHERS = [
    *FIRSTS, "2019-02-30", "13/13/2020", "2019-12-31 23:59:59.999", "2019-12-31T23:59:59", "2019-12-31T23:59:59Z", "yesterday", "", "2019-04-07 08:15:09 ",
    "2019-04-07T08:15:09.1", "24/12/1999", "2019-13-01",
]


@pytest.mark.parametrize("first", FIRSTS)
def test_a_column_is_read_as_its_first_value(spark, first):
    """As the usual CSV tools infer it: values of another shape become missing."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = pd.to_datetime(pd.Series([first, *OTHERS]), errors="coerce")
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, first, *OTHERS])], "i long, t string")
    shapes = infer_time_shapes(df, {"t": (F.col("t"), ["i"])})
    got = [r[0] for r in df.orderBy("i").select(shape_timestamp("t", shapes["t"]).alias("t")).collect()][1:]
    assert got == [None if pd.isna(x) else x.to_pydatetime() for x in want]


def test_shapes_with_zone_keep_the_wall_clock_and_unknown_ones_read_each_value(spark):
    df = spark.createDataFrame([(0, "2019-12-31T23:59:59Z"), (1, "2020-01-01T10:00:00+02:00"), (2, "2020-01-01T10:00:00")], "i long, t string")
    shape = infer_time_shapes(df, {"t": (F.col("t"), ["i"])})["t"]
    got = [r[0] for r in df.orderBy("i").select(shape_timestamp("t", shape)).collect()]
    assert got == [dt.datetime(2019, 12, 31, 23, 59, 59), dt.datetime(2020, 1, 1, 10), None]
    assert [time_shape(t) for t in ("yesterday", "2019-02-30", "", None, "10:00")] == [None] * 5
    odd = spark.createDataFrame([(0, "some day"), (1, "2020-01-01"), (2, "3/4/2020")], "i long, t string")
    shape = infer_time_shapes(odd, {"t": (F.col("t"), ["i"])})["t"]
    assert [r[0] for r in odd.orderBy("i").select(shape_timestamp("t", shape)).collect()] == [None, dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 4)]


def test_transform_with_inferred_formats(raw):
    """The first purchase time is `Y-m-d H:M:S`; the US date of r15 and the T of r12 are not, so they are lost."""
    lines = transform(raw, Params(timestamps="infer")).lines
    dates = {(r.order_id, r.date_key) for r in lines.collect()}
    assert dates == {("r11", 20190407), ("r12", None), ("r13", 20200229), ("r15", None), ("r17", None)}
    with pytest.raises(ValueError, match="timestamps"):
        Params(timestamps="guess")


# ----------------------------------------------------------------------------- rejects


def test_each_line_that_does_not_load_has_its_reason(raw, spark):
    staged = transform(raw, Params())
    star = materialize(load_star(None, staged, Params(), T1)[0])
    days = star["dim_date"].where("date_key <> 20191231")
    products = star["dim_product"].where("product_id <> 's-toy'")
    lines = staged.lines.withColumn("price", F.when(F.col("product_id") != "s-ring", F.col("price")))
    more = spark.createDataFrame([("r99", 1, None, "s-lamp", 20190407, "created", 1.0, 0.0, 1)], lines.drop("_ord").schema)
    lines = lines.drop("_ord").unionByName(more)
    tagged = cut_lineage(tag_fact_lines(lines, star["dim_customer"], products, days, star["dim_status"]), "t-tagged")
    facts, rejects = route_fact_lines(tagged)
    got = sorted((r.order_id, r.product_id, r.reason) for r in rejects.collect())
    assert got == [
        ("r12", "s-rug", "date_not_in_dim"), ("r12", "s-shirt", "date_not_in_dim"), ("r13", "s-kite", "customer"), ("r15", "s-ring", "price"),
        ("r15", "s-toy", "product"), ("r15", "s-toy", "product"), ("r17", "s-rug", "no_date"), ("r99", "s-lamp", "customer"),
    ]
    assert {r.reason for r in rejects.collect()} == set(REJECT_REASONS)
    want = resolve_fact_keys(lines, star["dim_customer"], products, days, star["dim_status"])
    assert sorted(map(tuple, facts.collect())) == sorted(map(tuple, want.collect()))
    counts = tagged.agg(*[c.alias(k) for k, c in reason_counts().items()]).first().asDict()
    assert sum(counts.values()) == lines.count() and counts["accepted"] == facts.count()


def config(fixture_dir, tmp_path, **more):
    return PipelineConfig(
        sources={n: f"{fixture_dir}/{n}.csv" for n in ("customers", "orders", "order_items", "products")},
        api_products=f"{fixture_dir}/api_products.json",
        order_events=f"{fixture_dir}/order_events.csv",
        **{f"{z}_root": str(tmp_path / z) for z in ("raw", "staging", "warehouse")},
        **more,
    )


def test_pipeline_keeps_rejects_and_measures(spark, fixture_dir, tmp_path):
    cfg = config(fixture_dir, tmp_path, reject_root=str(tmp_path / "rejects"), gate_root=str(tmp_path / "gate"))
    r1 = run_pipeline(spark, cfg, Params(), T1)
    assert {k: v for k, v in r1.counters.items() if k.startswith("facts_")} == {
        "facts_inserted": 5, "facts_skipped": 3, "facts_accepted": 6, "facts_customer": 1, "facts_product": 0, "facts_no_date": 1,
        "facts_date_not_in_dim": 0, "facts_price": 0,
    }
    rejects = spark.read.parquet(f"{cfg.reject_root}/load_version=1")
    assert sorted((r.order_id, r.reason) for r in rejects.collect()) == [("r13", "customer"), ("r17", "no_date")]
    r2 = run_pipeline(spark, cfg, Params(), T2, steps=("load", "quality"))
    assert r2.version == 2 and r2.quality["results"] == r1.quality["results"]
    # A load whose measures are missing is measured at the gate.
    lost = replace(cfg, gate_root=str(tmp_path / "none"))
    assert run_pipeline(spark, lost, Params(), T3, steps=("quality",)).quality["results"] == r1.quality["results"]


# ----------------------------------------------------------------------------- skewed lookup


def test_heavy_hitters_are_broadcast_and_not_moved(spark, quiet):
    n = 40_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 5000).cast("string"))
    rows = cut_lineage(spark.range(0, n, numPartitions=8).select("id", key.alias("customer_id")), "t-skewed")
    dim = spark.range(4000).select(F.col("id").cast("string").alias("customer_id"), F.col("id").alias("customer_key"))
    dim = dim.unionByName(spark.createDataFrame([("hot", -1)], dim.schema))
    hot = heavy_hitters(rows, ["customer_id"], share=0.05)["customer_id"]
    assert hot == ["hot"]
    got = lookup_skewed(rows, dim, "customer_id", hot)
    p = plan(got)
    assert p.count("BroadcastHashJoin") == 1 and p.count("SortMergeJoin") == 1
    want = rows.join(dim, "customer_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 0.2 * sum(sizes)  # the hot third lies in its input partitions
    plain = max(r["count"] for r in want.groupBy(F.spark_partition_id()).count().collect())
    assert plain > n / 3


def test_no_heavy_hitter_is_a_plain_join(spark, quiet):
    rows = spark.range(1000).select((F.col("id") % 500).cast("string").alias("customer_id"))
    dim = spark.range(500).select(F.col("id").cast("string").alias("customer_id"), F.col("id").alias("customer_key"))
    hot = heavy_hitters(rows, ["customer_id"], share=0.01)["customer_id"]
    assert hot == [] and "BroadcastHashJoin" not in plan(lookup_skewed(rows, dim, "customer_id", hot))
    empty = heavy_hitters(rows.limit(0), ["customer_id"])
    assert empty == {"customer_id": []}


def test_skewed_and_plain_lookups_agree(raw):
    staged = transform(raw, Params())
    star = materialize(load_star(None, staged, Params(), T1)[0])
    dims = [star[d] for d in ("dim_customer", "dim_product", "dim_date", "dim_status")]
    lines = cut_lineage(staged.lines, "t-lines")
    a, b = resolve_fact_keys(lines, *dims), resolve_fact_keys_skewed(lines, *dims)
    assert a.dtypes == b.dtypes and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def moved_columns(df):
    """The columns of each shuffle of the plan."""
    formatted = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(formatted)
    return [re.findall(r"(\w+)#", cols) for cols in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_lines_staged_in_buckets_are_not_moved(raw, quiet):
    """Only keys move to the dimensions and back; hashed by order, the lines lie where they were staged."""
    plain, staged = stage(transform(raw, Params())), stage(transform(raw, Params()), buckets=4)
    want, got = (load_star(None, s, Params(), T1) for s in (plain, staged))
    facts = got[1].inserted["fact_orders"]
    cols = [c for c in facts.columns if c != "fact_id"]
    ids = [r.fact_id for r in facts.collect()]
    assert len(set(ids)) == len(ids) and min(ids) > 0
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(facts.select(*cols)) == rows(want[0]["fact_orders"].select(*cols))
    dims = [got[0][d] for d in ("dim_customer", "dim_product", "dim_date", "dim_status")]
    lines = staged.lines.withColumn("customer_id", F.when(F.col("price") > 10, F.col("customer_id")))
    hot = heavy_hitters(lines, ["customer_id", "product_id"])
    assert hot["customer_id"] and hot["product_id"]  # and some are not
    skewed = resolve_fact_keys_skewed(lines, *dims, buckets=4)
    assert rows(skewed) == rows(resolve_fact_keys(lines, *dims)) == rows(resolve_fact_keys(lines, *dims, buckets=4))
    for df in (facts, skewed):
        moved = moved_columns(df)
        assert moved and not [c for c in moved if "price" in c]
    assert [c for c in moved_columns(want[1].inserted["fact_orders"]) if "price" in c]


# ----------------------------------------------------------------------------- logs of dimensions and status


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, city string, state string, zip_code string, _ord long")


def test_dimension_log_moves_only_the_batch(spark, quiet, tmp_path):
    log = bucketed_table(f"file:{tmp_path}/log", DIM_CUSTOMER, ["customer_id"], 4)
    attrs = ["city", "state", "zip_code"]
    batches = [
        [(f"c{i}", "A", "x", "1", i) for i in range(50)],
        [("c3", "B", "x", "1", 1), ("c3", "C", None, "1", 2), ("n1", "D", "x", "1", 3), (None, "E", "x", "1", 4)],
        [("n1", "F", "y", "2", 1), ("n2", "G", "y", "2", 2)],
    ]
    target = spark.createDataFrame([], DIM_CUSTOMER)
    start = 0
    for v, (rows, ts) in enumerate(zip(batches, (T1, T2, T3), strict=True), 1):
        batch = cut_lineage(customers(spark, rows), "t-batch")
        delta = scd1_delta(log.read(spark), batch, "customer_id", attrs, "customer_key", ts, ["_ord"], 4, start)
        if v > 1:
            p = plan(delta)
            # The batch is shuffled; the log lies in its buckets.
            assert p.count("Exchange hashpartitioning(customer_id") == 1 and p.count("Exchange") == 1, p
        log.append(delta, v)
        assert log.read(spark, [v]).count() == len({r[0] for r in rows if r[0]})  # nothing else is written
        start = log.read(spark).agg(F.max("customer_key")).first()[0]
        target, _ = scd1_merge(target, batch, "customer_id", attrs, "customer_key", ts, ["_ord"])
        target = cut_lineage(target, "t-dim")
    current = latest_rows(log.read(spark), "customer_id")
    assert "Exchange" not in plan(current)
    own = ["customer_id", *attrs, "updated_at"]
    assert sorted(map(repr, current.select(*own).collect())) == sorted(map(repr, target.select(*own).collect()))
    keys = {r.customer_id: r.customer_key for r in current.collect()}
    first = {r.customer_id: r.customer_key for r in log.read(spark, [1]).collect()}
    assert all(keys[c] == k for c, k in first.items()) and len(set(keys.values())) == len(keys)
    assert max(first.values()) < keys["n1"] < keys["n2"]


def test_a_load_is_appended_once_and_unknown_loads_are_not_read(spark, tmp_path):
    log = bucketed_table(f"file:{tmp_path}/l", "k string, v long", ["k"], 2)
    assert log.read(spark).count() == 0
    log.append(spark.createDataFrame([("a", 1)], "k string, v long"), 1)
    log.append(spark.createDataFrame([("a", 2)], "k string, v long"), 2)
    with pytest.raises(ValueError, match="written already"):
        log.append(spark.createDataFrame([("a", 9)], "k string, v long"), 2)
    assert [r.v for r in log.read(spark, [1, 7]).collect()] == [1] and log.read(spark, [7]).count() == 0


def test_status_state_of_batches_in_any_order(spark, raw, quiet, tmp_path):
    events = cut_lineage(parse_events(raw.order_events, ()), "t-events")
    want = {(r.order_id, r.latest_event_status) for r in latest_status(events).collect()}
    state = bucketed_table(f"file:{tmp_path}/state", STATUS_STATE_SCHEMA, ["order_id"], 4)
    for v, part in enumerate((1, 2, 0), 1):
        state.append(status_state(events.where(F.col("event_id") % 3 == part)), v)
    got = latest_from_state(state.read(spark))
    assert "Exchange" not in plan(got)
    assert {(r.order_id, r.latest_event_status) for r in got.collect()} == want and len(want) == 4


# ----------------------------------------------------------------------------- screen


def test_new_keys_read_no_fact_and_known_ones_are_found(spark, tmp_path):
    keys = ["order_id", "order_item_seq"]
    rows = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 3).alias("order_item_seq"), F.lit(1.0).alias("price"))
    facts = bucketed_table(f"file:{tmp_path}/f", "order_id string, order_item_seq long, price double", keys, 4)
    screen = f"{tmp_path}/screen"
    for v, (a, b) in enumerate([(0, 1000), (1000, 1500)], 1):
        facts.append(rows(a, b), v)
        key_bitmaps(facts.read(spark, [v]), keys, slots_for(b - a) * v).write.parquet(f"{screen}/load_version={v}")
    known = spark.read.parquet(screen)
    assert sorted(r[0] for r in known.select("slots").distinct().collect()) == [1, 2]
    tagged = screened(rows(900, 1100), known, keys)
    assert all(1 in r.hits if int(r.order_id) < 1000 else 2 in r.hits for r in tagged.collect())  # no key is overlooked
    new, loads = screened_new_rows(cut_lineage(rows(900, 1600), "t-b"), facts.read(spark), known, keys)
    assert loads == [1, 2] and sorted(int(r.order_id) for r in new.collect()) == list(range(1500, 1600))
    # Keys no load has a bit for: found by asking, then the facts are not in the plan.
    asked = screened(rows(10**6, 10**6 + 400), known, keys)
    fresh = cut_lineage(asked.where(F.size("hits") == 0).drop("hits"), "t-fresh")
    new, loads = screened_new_rows(fresh, facts.read(spark), known, keys)
    assert loads == [] and facts.name not in plan(new) and new.count() == fresh.count() > 300
    assert "Location" not in plan(new) or "load_version" not in plan(new)


def test_false_alarms_cost_a_comparison_only(spark, tmp_path):
    keys = ["k"]
    old = spark.range(0, 60_000, 2).select(F.col("id").alias("k"))
    full = key_bitmaps(old, keys, 1).withColumn("load_version", F.lit(1))
    assert full.count() == 1 and full.select(F.bitmap_count("bits")).first()[0] > 0.5 * SLOT_BITS
    facts = old.withColumn("load_version", F.lit(1))
    batch = cut_lineage(spark.range(0, 1000).select(F.col("id").alias("k")), "t-k")
    hits = screened(batch, full, keys).where(F.size("hits") > 0).count()
    assert 500 + 150 < hits < 1000  # every second key is known, many others are false alarms
    new, loads = screened_new_rows(batch, facts, full, keys)
    assert loads == [1] and sorted(r.k for r in new.collect()) == list(range(1, 1000, 2))
    none, loads = screened_new_rows(batch, facts.limit(0), full.limit(0), keys)
    assert loads == [] and none.count() == 1000


# ----------------------------------------------------------------------------- incremental gate


def test_gate_from_measures_equals_the_full_gate(spark, raw, tmp_path):
    staged = transform(raw, Params())
    star = materialize(load_star(None, staged, Params(), T1)[0])
    facts = star["fact_orders"]
    bad = facts.withColumn("customer_key", F.when(F.col("order_item_seq") > 1, None).otherwise(F.col("customer_key")))
    for table in (facts, bad, facts.limit(0)):
        for v, part in enumerate((table.where("order_id = 'r12'"), table.where("order_id <> 'r12'")), 1):
            load_measures(part).write.mode("overwrite").parquet(f"{tmp_path}/gate/load_version={v}")
        measures = spark.read.parquet(f"{tmp_path}/gate").drop("load_version")
        for gone in ("s-rug", "nothing"):
            dims = {**star, "fact_orders": table, "dim_product": star["dim_product"].where(F.col("product_id") != gone)}
            want = sorted(map(tuple, quality_checks(dims, staged.lines, Params()).collect()))
            got = incremental_quality_checks(measures, dims, staged.lines, Params())
            assert sorted(map(tuple, got.collect())) == want
            merged = incremental_quality_checks(merged_measures(measures), dims, staged.lines, Params())
            assert sorted(map(tuple, merged.collect())) == want
            assert "fact_id" not in got._jdf.queryExecution().optimizedPlan().toString()  # no fact is read


# ----------------------------------------------------------------------------- layout


def test_clustered_files_are_sorted_disjoint_and_skipped(spark, tmp_path):
    df = spark.range(0, 20_000, numPartitions=8).select(
        (F.xxhash64("id") % 1000).cast("string").alias("order_id"), F.col("id").alias("n"), F.when(F.col("id") % 9 != 0, F.col("id") % 77).alias("t")
    )
    path = write_clustered(df, f"{tmp_path}/good", ["order_id", "t", "n"], partitions=8)
    report = layout_report(spark, path, ["order_id", "t", "n"]).first()
    assert (report.rows, report.unsorted_rows, report.overlapping_files) == (20_000, 0, 0) and report.files > 4
    df.write.parquet(f"{tmp_path}/bad")
    report = layout_report(spark, f"{tmp_path}/bad", ["order_id", "t", "n"]).first()
    assert report.unsorted_rows > 1000 and report.overlapping_files > 4
    # A filter on the first column reads the row groups that can hold it.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for name in ("good", "bad"):
            found = spark.read.parquet(f"{tmp_path}/{name}").where("order_id = '17'")
            found.collect()
            leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
            read[name] = leaves.head().metrics().get("numOutputRows").get().value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["good"] < 0.2 * 20_000 < read["bad"]
    df.limit(0).write.parquet(f"{tmp_path}/none")
    assert tuple(layout_report(spark, f"{tmp_path}/none", ["order_id"]).first())[1:] == (0, 0, 0)


# ----------------------------------------------------------------------------- aliases


def test_lines_of_a_dropped_alias_load_on_request(raw, spark):
    assert [tuple(r) for r in customer_aliases(raw.customers).collect()] == [("k-ana2", "k-ana")]
    loaded = {}
    for on in (False, True):
        params = Params(resolve_aliases=on)
        star = load_star(None, transform(raw, params), params, T1)[0]
        loaded[on] = {(r.order_id, r.customer_key) for r in star["fact_orders"].collect()}
    assert loaded[True] - loaded[False] == {("r13", 1)} and loaded[False] < loaded[True]
    lines = clean_orders(raw.orders, raw.order_items, None, Params(resolve_aliases=True)).lines
    assert "k-ana2" in {r.customer_id for r in lines.collect()}  # the cleaning itself does not change


def test_alias_of_two_people_goes_to_its_first_row(spark):
    rows = [(1, "a", "p"), (2, "b", "p"), (3, "b", "q"), (4, "c", "q"), (5, "d", "r"), (6, "d", "r"), (7, None, "p"), (8, "e", None)]
    df = spark.createDataFrame(rows, "_ord long, customer_id string, customer_unique_id string")
    # b's first group is p, kept by a; but b is kept for q, so it is a customer; c goes to b.
    assert sorted(tuple(r) for r in customer_aliases(df).collect()) == [("c", "b")]


def test_star_of_a_crashed_load_is_the_one_before(spark, fixture_dir, tmp_path):
    from starloom.plans.incremental import crash_after_facts

    cfg = config(fixture_dir, tmp_path)
    run_pipeline(spark, cfg, Params(), T1)
    crash_after_facts(spark, cfg.warehouse_root)
    assert {r.price for r in read_star(spark, cfg.warehouse_root)["fact_orders"].collect()} == {41.75, 260.4, 18.99, 77.07, 6.35}
    assert run_pipeline(spark, cfg, Params(), T2, steps=("load",)).version == 3
    assert read_star(spark, cfg.warehouse_root)["fact_orders"].count() == 5


def test_sources_of_two_loads_share_their_files(spark, tmp_path):
    from starloom.plans import incremental
    from starloom.plans import testdata as td
    from starloom.sources.csv import ORD, read_csv

    sf = str(tmp_path)
    lines = [(i % 7, 1 + i % 3, (i * 37) % 50, i % 9, "R" if i % 4 == 0 else "N", i + 0.5, 2.0, dt.datetime(1997, 1, 1 + i % 20)) for i in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_returnflag string, l_extendedprice double, l_quantity double, l_shipdate timestamp").write.parquet(f"{sf}/lineitem.parquet")
    orders = [(i, i, "F", dt.datetime(1997 + i % 2, 5, 1), "1-URGENT") for i in range(7)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame([(i, f"c{i}", "AUTO", 1.0, i) for i in range(7)], "c_custkey long, c_name string, c_mktsegment string, c_acctbal double, c_nationkey long").write.parquet(f"{sf}/customer.parquet")
    spark.createDataFrame([(i, f"p{i}", "LARGE", 3, 1.5) for i in range(50)], "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double").write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(i, i % 7, "click", dt.datetime(2024, 1, 1)) for i in range(20)], "event_id long, user_id long, event_type string, ts timestamp").write.parquet(f"{sf}/events.parquet")
    first = incremental.write_sources(spark, sf, f"{sf}/out", early_only=True)
    second = incremental.write_sources(spark, sf, f"{sf}/out", early_only=False, others=first)
    assert {n for n in first.sources if first.sources[n] != second.sources[n]} == {"orders"}
    assert second.order_events == first.order_events and second.api_products == first.api_products
    assert read_csv(spark, first.sources["orders"], "orders").count() == 4 and read_csv(spark, second.sources["orders"], "orders").count() == 7
    files = [f for folder in second.sources.values() for f in spark.read.format("binaryFile").load(folder).select("path").collect()]
    assert files and all(f["path"].endswith(".csv.gz") for f in files)
    # In input order, all of them.
    got = [r["product_id"] for r in read_csv(spark, second.sources["order_items"], "order_items").orderBy(ORD).collect()]
    assert got == [str(p) for p in sorted(r[2] for r in lines)]
    want = td.raw_order_items(spark, sf).select("order_id", "product_id", "price")
    assert sorted(map(tuple, want.collect())) == sorted((r["order_id"], r["product_id"], r["price"] or "NaN") for r in read_csv(spark, second.sources["order_items"], "order_items").collect())
