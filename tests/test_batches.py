"""Answers on second batches: silver, batch replacement, typed partitions, SCD order, medians, streams."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lakelayer.contracts import get_contract
from lakelayer.operators import dq
from lakelayer.operators import merge as M
from lakelayer.operators.stats import grouped_median
from lakelayer.plans import bronze as B
from lakelayer.plans import silver as SV
from lakelayer.sinks.store import PathTable
from lakelayer.sources.csv import read_csv_contract


def test_later_batch_wins_in_silver(spark, tmp):
    def batch(n, rows):
        at = F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp")
        df = spark.createDataFrame(rows, "order_id string, status string, price long, purchase_ts string")
        return df.withColumn("_batch_id", F.lit(f"00{n}")).withColumn("_ingested_at", at)

    order = ["_batch_id", "_ingested_at", "purchase_ts"]
    one = batch(1, [("a", "shipped", 900, "t1"), ("b", "shipped", 900, "t1")])
    two = batch(2, [("a", "delivered", 500, "t1"), ("c", "created", 1, "t2")])
    for src in (one, two, one):  # the first batch once more changes nothing
        t, _ = SV.silver_upsert(spark, src, ["order_id"], order, tmp + "/s", latest_wins=True)
    got = {r.order_id: (r.status, r.price) for r in t.read().collect()}
    assert got == {"a": ("delivered", 500), "b": ("shipped", 900), "c": ("created", 1)}


def orders_csv(path, rows):
    c = get_contract("olist_orders")
    with open(path, "w") as f:
        f.write(",".join(x.header for x in c.fields) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")
    return str(path)


def order_row(i, ts="2024-01-01 10:00:00"):
    fields = get_contract("olist_orders").fields
    return [ts if f.type.startswith("timestamp") else f"{f.name}{i}" for f in fields]


def test_corrected_batch_replaces_clean_and_rejected_rows(spark, tmp_path):
    bad = order_row(2)
    bad[0] = ""
    root = str(tmp_path / "t")
    first = B.ingest(spark, "olist_orders", orders_csv(tmp_path / "a.csv", [order_row(1), bad]), root, "001")
    assert (first.total_rows, first.clean_rows, first.quarantine_rows) == (2, 1, 1)
    B.ingest(spark, "olist_orders", orders_csv(tmp_path / "c.csv", [order_row(7)]), root, "2024-01-01")
    again = B.ingest(spark, "olist_orders", orders_csv(tmp_path / "b.csv", [order_row(1), order_row(2)]), root, "001")
    assert (again.total_rows, again.clean_rows, again.quarantine_rows) == (2, 2, 0)
    rows = again.table.read().groupBy("_batch_id", "_status").count().collect()
    assert sorted(map(tuple, rows)) == [("001", "clean", 2), ("2024-01-01", "clean", 1)]


def test_partition_values_keep_their_types(spark, tmp):
    t = PathTable(spark, tmp + "/p", partition_by=["k"])
    t.overwrite(spark.createDataFrame([("001", 1), ("1e3", 2), ("2024-01-01", 3), (None, 4)], "k string, v int"))
    assert {(r.k, r.v) for r in t.read().collect()} == {("001", 1), ("1e3", 2), ("2024-01-01", 3), (None, 4)}
    t.overwrite_partitions(spark.createDataFrame([("001", 9)], "k string, v int"))
    assert t.read().filter("k = '001'").collect()[0].v == 9 and t.read().count() == 4


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "k int, city string")


def test_three_snapshots_and_a_late_one(spark, tmp):
    t = M.scd2_initial(snapshot(spark, [(1, "x"), (2, "y")]), "k", ["city"], "2024-01-01")
    t = M.scd2_merge(t, snapshot(spark, [(1, "x2"), (2, "y")]), "k", ["city"], "2024-02-01")
    with pytest.raises(M.OutOfOrderError):
        M.scd2_merge(t, snapshot(spark, [(1, "late")]), "k", ["city"], "2024-01-15")
    t = M.scd2_merge(t, snapshot(spark, [(1, "x3"), (2, "y2"), (3, "z")]), "k", ["city"], "2024-03-01")
    rows = sorted((r.k, r.valid_from, r.valid_to, r.is_current) for r in t.collect())
    for a, b in zip(rows, rows[1:]):
        if a[0] == b[0]:
            assert a[2] == b[1] - dt.timedelta(days=1)
    assert sum(r[3] for r in rows) == 3 and len(rows) == 6


def test_merges_refuse_bad_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    for rows in ([(1, "b"), (1, "c")], [(None, "b")]):
        with pytest.raises(M.DuplicateKeyError):
            M.merge_scd1(t, spark.createDataFrame(rows, "k int, v string"), "k")


@pytest.mark.parametrize("small", [1, 3, 1_000_000])
def test_median_equals_the_plain_aggregate(spark, small):
    nan = float("nan")
    rows = [(None, x) for x in (1.0, 1.0, 1.0, None)] + [("n", None), ("n", None), ("w", 1e-300), ("w", 1e300), ("w", -1e308), ("w", 5e-324), ("w", 0.0)]
    rows += [("q", nan), ("q", nan), ("q", nan), ("q", 1.0), ("h", nan), ("h", 2.0), ("h", 3.0), ("h", 7.0), ("h", 9.0), ("e", 0.1), ("e", 0.7)]
    df = spark.createDataFrame(rows, "g string, v double")
    show = lambda frame: sorted((str(r.g), "nan" if r.m is not None and math.isnan(r.m) else r.m) for r in frame.collect())
    assert show(grouped_median(df, ["g"], "v", "m", small_group_rows=small)) == show(df.groupBy("g").agg(F.median("v").alias("m")))


def test_unique_rule_counts_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert dq.report(df, [dq.Rule.unique_key("a", "b")]).collect()[0].n_failed == 1


def test_by_name_refuses_another_column_order(spark, tmp_path):
    c = get_contract("olist_sellers")
    names = [f.header for f in c.fields]
    for n, order in (("a", names), ("b", names[::-1])):
        (tmp_path / f"{n}.csv").write_text(",".join(order) + "\n" + ",".join(f"{x}1" for x in order) + "\n")
        row = read_csv_contract(spark, str(tmp_path / f"{n}.csv"), c, match_by_name=True).collect()[0]
        assert row[c.fields[0].name] == f"{c.fields[0].header}1"
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_contract(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], c, match_by_name=True).collect()


def test_stream_quotes_and_a_second_checkpoint(spark, tmp_path):
    from lakelayer.streaming.ingest import bronze_stream

    c = get_contract("olist_orders")
    row = order_row(1)
    row[1] = '"say ""hi"", you"'
    (tmp_path / "in").mkdir()
    orders_csv(tmp_path / "in" / "a.csv", [row])
    root = str(tmp_path / "t")
    for n in (1, 2):
        bronze_stream(spark, c, str(tmp_path / "in"), root, str(tmp_path / f"ck{n}")).awaitTermination()
    rows = PathTable(spark, root).read().collect()
    assert len(rows) == 2 and {r._status for r in rows} == {"clean"} and rows[0][c.fields[1].name] == 'say "hi", you'


def test_no_machine_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from lakelayer.session import checkpoint_root

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        checkpoint_root(SimpleNamespace(conf={}, sparkContext=context))
