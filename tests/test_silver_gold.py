"""Silver and gold operators on small fixtures, checked by brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import dq
from lakelayer.operators.dedup import dedup_latest
from lakelayer.operators.rollup import allocate, latest_per_key
from lakelayer.operators.stats import grouped_median
from lakelayer.plans import gold as G
from lakelayer.sinks.store import PathTable


def test_dedup_keeps_latest_with_total_order(spark):
    rows = [(1, 1, "2024-01-01", "a"), (1, 1, "2024-01-03", "b"), (1, 1, "2024-01-03", "c"), (2, 1, "2024-01-01", "d")]
    df = spark.createDataFrame(rows, "k1 int, k2 int, ts string, v string")
    got = sorted(tuple(r) for r in dedup_latest(df, ["k1", "k2"], ["ts"]).collect())
    assert got == [(1, 1, "2024-01-03", "c"), (2, 1, "2024-01-01", "d")]


def test_dedup_matches_brute_force_with_ties_and_nulls(spark):
    """Survivor = greatest (order..., then every other column in column order),
    NULL below any value, as Spark orders structs."""
    rnd = random.Random(11)
    pick = lambda xs: rnd.choice(xs)
    rows = [
        (pick([1, 2, 3]), pick(["2024-01-01", "2024-01-02", None]), pick([None, 0, 5, 9]), pick(["a", "b", None]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "k int, ts string, n int, v string")
    got = sorted(dedup_latest(df, "k", ["ts"]).collect(), key=lambda r: r.k)

    def rank(r):
        return tuple((0,) if x is None else (1, x) for x in (r[1], r[2], r[3]))

    want = {}
    for r in rows:
        if r[0] not in want or rank(r) > rank(want[r[0]]):
            want[r[0]] = r
    assert [tuple(r) for r in got] == [want[k] for k in sorted(want)]


def test_dedup_is_an_aggregate_not_a_window(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = dedup_latest(df, "k", ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_dq_report_and_fail_mode(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (2, None)], "k int, q double")
    rules = [dq.Rule.positive("q"), dq.Rule.unique_key("k"), dq.Rule.not_null("k")]
    got = {r.rule: (r.n_rows, r.n_failed, r.passed) for r in dq.report(df, rules).collect()}
    assert got == {"positive:q": (3, 2, False), "unique:k": (3, 1, False), "not_null:k": (3, 0, True)}
    assert len(dq.enforce(df, rules, "warn")) == 3
    with pytest.raises(dq.DataQualityError, match="positive:q=2"):
        dq.enforce(df, rules, "fail")


@pytest.mark.parametrize("small_rows,max_bc", [(1_000_000, 100_000), (7, 100_000), (7, 0)])
def test_grouped_median_exact(spark, small_rows, max_bc):
    rnd = random.Random(7)
    rows = [("hot", rnd.choice([1.5, 2.25, 3.0, rnd.uniform(-50, 50)])) for _ in range(301)]
    rows += [("even", float(v)) for v in (4, 1, 3, 2)] + [("one", 9.0), ("dup", 5.0), ("dup", 5.0), ("dup", 5.0)]
    rows += [("skew", 1e-9 * i) for i in range(40)] + [("skew", 1e12)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in grouped_median(df, ["g"], "v", small_group_rows=small_rows, max_broadcast_groups=max_bc).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want[g] = statistics.median([v for k, v in rows if k == g])
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-15), g


def test_dim_date_full_range(spark):
    d = G.dim_date(spark)
    assert d.count() == 5844
    rows = {str(r.date_id): r for r in d.filter(F.col("date_id").isin(
        "2016-02-29", "2024-03-29", "2024-04-21", "2024-11-20", "2023-11-20", "2025-04-18", "2030-12-31", "2015-01-03"
    )).collect()}
    assert rows["2016-02-29"].month == 2 and rows["2016-02-29"].day_name == "Monday"
    assert rows["2024-03-29"].is_holiday_br  # Good Friday 2024
    assert rows["2025-04-18"].is_holiday_br  # Good Friday 2025
    assert rows["2024-04-21"].is_holiday_br and rows["2024-04-21"].is_weekend and rows["2024-04-21"].day_of_week == 7
    assert rows["2024-11-20"].is_holiday_br and not rows["2023-11-20"].is_holiday_br
    assert rows["2015-01-03"].is_weekend and rows["2030-12-31"].quarter == 4
    assert d.select("date_sk").distinct().count() == 5844


def test_dim_date_written_once(spark, tmp):
    t = PathTable(spark, f"{tmp}/dim_date")
    assert G.write_once(t, G.dim_date(spark, "2020-01-01", "2020-01-31"))
    assert not G.write_once(t, G.dim_date(spark, "2020-01-01", "2020-12-31"))
    assert t.read().count() == 31


def test_allocation_sums_to_parent(spark):
    items = spark.createDataFrame([(1, 10.0), (1, 30.0), (2, 0.0), (2, 0.0)], "o int, price double")
    pays = spark.createDataFrame([(1, 100.0), (2, 8.0)], "o int, paid double")
    out = allocate(items, "o", "price", pays, "paid", "paid_alloc")
    sums = {r.o: r.s for r in out.groupBy("o").agg(F.sum("paid_alloc").alias("s")).collect()}
    assert sums == {1: pytest.approx(100.0), 2: pytest.approx(8.0)}
    assert out.count() == 4


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 1, 3), (1, "2024-01-02", 2, 5), (1, "2024-01-02", 1, 4)], "k int, ts string, id int, score int")
    r = latest_per_key(df, "k", ["score"], ["ts", "id"]).collect()[0]
    assert (r.score, r.n_rows) == (5, 3)


def test_point_in_time_join_picks_version(spark):
    from lakelayer.operators import merge as M

    v1 = spark.createDataFrame([(1, "x")], "customer_id int, city string")
    dim = M.scd2_initial(v1, "customer_id", ["city"], "2024-01-01", sk_col="customer_sk")
    dim = M.scd2_merge(dim, spark.createDataFrame([(1, "y")], "customer_id int, city string"), "customer_id", ["city"], "2024-02-01", sk_col="customer_sk")
    fact = spark.createDataFrame(
        [(1, dt.datetime(2020, 5, 1)), (1, dt.datetime(2024, 1, 15)), (1, dt.datetime(2024, 3, 1))], "customer_id int, purchase_ts timestamp"
    )
    out = G.point_in_time_join(fact, dim, "customer_id", "customer_id", "purchase_ts", ["customer_sk", "city"])
    got = sorted((str(r.purchase_ts)[:10], r.city) for r in out.collect())
    assert got == [("2020-05-01", "x"), ("2024-01-15", "x"), ("2024-03-01", "y")]


def test_fact_pruned_scan_uses_partition_filters(spark):
    from lakelayer.plans.catalog import QUERIES

    df = QUERIES["fact_pruned"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year_month" in plan


def test_written_dimensions_live_under_the_checkpoint_dir(spark):
    from lakelayer.plans.warehouse import dim_seller_upsert
    from lakelayer.session import checkpoint_root

    d = dim_seller_upsert(spark, "/root/testdata/sf0.001")
    assert d.inputFiles() and all(checkpoint_root(spark) in f for f in d.inputFiles())


def test_reports_and_fact_build_write_nothing(spark):
    from lakelayer.plans import warehouse as W

    for build in (W.order_items, W.fact_orders):
        files = build(spark, "/root/testdata/sf0.001").inputFiles()
        assert files and all("/root/testdata/sf0.001" in f for f in files)


def test_as_of_lookup_takes_the_version_of_the_date(spark):
    """Each item has one row, and both versions of the changed customers are used."""
    from lakelayer.plans import warehouse as W

    sf = "/root/testdata/sf0.001"
    fact = W.fact_orders_history(spark, sf).select("order_id", "order_item_id", "customer_sk", "payment_value", "payment_value_alloc").collect()
    assert len(fact) == len({(r.order_id, r.order_item_id) for r in fact}) == W.items(spark, sf).count()
    versions = {r.customer_sk: (r.customer_id, r.is_current) for r in W.dim_customer_history(spark, sf).collect()}
    used = {versions[r.customer_sk] for r in fact}
    assert any((c, True) in used and (c, False) in used for c, _ in used)
    paid, shared = {}, {}
    for r in fact:
        c = versions[r.customer_sk][0]
        if r.payment_value is not None:
            paid[c], shared[c] = r.payment_value, shared.get(c, 0.0) + r.payment_value_alloc
    assert paid and all(abs(paid[c] - shared[c]) < 1e-6 for c in paid)
