"""The fact by change set, its plans, and silver by commit numbers."""

import datetime as dt

from pyspark.sql import functions as F

from lakelayer.contracts import get_contract
from lakelayer.plans import bronze as B
from lakelayer.plans import gold as G
from lakelayer.plans import olist
from lakelayer.plans import warehouse as W
from lakelayer.sinks.store import PathTable

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_over_stored_dimensions_needs_no_window(spark):
    assert "Window" not in plan_of(W.fact_orders_history(spark, SF))
    assert "Window" not in plan_of(W.fact_orders(spark, SF))


def test_period_of_the_date_dimension_prunes_partitions(spark):
    fact = W.stored_fact(spark, SF).read()
    quarter = G.dim_date(spark, "1992-01-01", "1999-12-31").filter("year = 1997 AND quarter = 4")
    picked = G.in_period(fact, quarter)
    assert "dynamicpruning" in plan_of(picked).lower()
    assert picked.count() == fact.filter(F.col("order_year_month").isin("1997-10", "1997-11", "1997-12")).count() > 0
    # Written once per application.
    assert W.stored_fact(spark, SF).version() == 1


def test_only_months_of_changed_orders_are_rewritten(spark, tmp):
    def orders(rows):
        return spark.createDataFrame([(o, dt.datetime.fromisoformat(f"{d} 10:00:00")) for o, d in rows], "order_id int, purchase_ts timestamp")

    before = [(1, "2024-01-05"), (2, "2024-02-05"), (3, "2024-02-07"), (4, "2024-03-01"), (5, "2024-04-01")]

    def build(of):
        return of.select("order_id", F.date_format("purchase_ts", "yyyy-MM").alias("order_year_month"))

    t = PathTable(spark, f"{tmp}/fact", partition_by=["order_year_month"])
    G.update_fact(t, orders(before), None, build)
    kept = {m: t.folders(f"order_year_month={m}") for m in ("2024-02", "2024-03")}
    # Order 1 was alone in January and moves to April; 9 is new.
    after = [(1, "2024-04-09"), *before[1:], (9, "2024-05-01")]
    changed = spark.createDataFrame([(1,), (9,)], "order_id int")
    assert G.update_fact(t, orders(after), changed, build) == ["2024-01", "2024-04", "2024-05"]
    assert sorted(map(tuple, t.read().collect())) == sorted((o, d[:7]) for o, d in after)
    assert {m: t.folders(f"order_year_month={m}") for m in kept} == kept
    assert G.update_fact(t, orders(after), changed.limit(0), build) == []


def deliver(spark, tmp_path, root, batch, rows):
    c = get_contract("olist_orders")
    path = tmp_path / f"{batch}-{len(list(tmp_path.iterdir()))}.csv"
    ts = "2024-01-01 10:00:00"
    lines = [",".join(f.header for f in c.fields)]
    lines += [",".join([o, "c1", status, ts, ts, ts, ts, ts]) for o, status in rows]
    path.write_text("\n".join(lines) + "\n")
    B.ingest(spark, c, str(path), f"{root}/bronze/olist_orders", batch)


def test_silver_follows_commits_not_names_or_clocks(spark, tmp_path):
    root = str(tmp_path / "lake")
    run = lambda: olist.run_silver(spark, root, only=["olist_orders"])
    state = lambda: {r.order_id: r.order_status for r in olist.silver(spark, root, "olist_orders").collect()}
    deliver(spark, tmp_path, root, "9", [("a", "shipped"), ("b", "shipped"), ("d", "shipped")])
    run()
    deliver(spark, tmp_path, root, "10", [("a", "delivered")])
    run()
    assert state() == {"a": "delivered", "b": "shipped", "d": "shipped"}
    version = PathTable(spark, f"{root}/silver/olist_orders/rows").version()
    # Batch 9 again, corrected: it stays before batch 10, and replaces its own rows.
    deliver(spark, tmp_path, root, "9", [("a", "late news"), ("b", "corrected")])
    # An earlier id that is committed last is new.
    deliver(spark, tmp_path, root, "08", [("d", "returned")])
    run()
    assert state() == {"a": "delivered", "b": "corrected", "d": "returned"}
    # A rerun that holds a key no more: the key falls back to what other batches say, or goes.
    deliver(spark, tmp_path, root, "11", [("e", "new"), ("b", "eleven"), ("f", "only here")])
    run()
    assert state()["b"] == "eleven" and state()["f"] == "only here"
    version = PathTable(spark, f"{root}/silver/olist_orders/rows").version() - 2
    deliver(spark, tmp_path, root, "11", [("e", "kept")])
    run()
    assert state() == {"a": "delivered", "b": "corrected", "d": "returned", "e": "kept"}
    version += 1
    run()  # nothing new: no rows are read or written
    t = PathTable(spark, f"{root}/silver/olist_orders/rows")
    assert t.notes()["bronze_version"] == PathTable(spark, f"{root}/bronze/olist_orders").version()
    assert t.version() == version + 3 and state()["b"] == "corrected"
