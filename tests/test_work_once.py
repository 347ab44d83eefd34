"""Work that is done once: conversions of a contract, snapshots of a history, rows of a merge."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.contracts import get_contract
from lakelayer.operators.contract import REASON_COL, apply_contract
from lakelayer.plans import warehouse as W
from lakelayer.sinks.keyed import KeyedTable


def test_each_cell_is_converted_once(spark):
    c = get_contract("olist_orders")
    stamps = [f for f in c.fields if f.type.startswith("timestamp")]
    good = {f.name: "2024-01-01 10:00:00" if f in stamps else "x" for f in c.fields}
    cells = [good, {**good, stamps[0].name: "2024-01-01"}, {**good, stamps[-1].name: None}]
    raw = spark.createDataFrame([tuple(x[f.name] for f in c.fields) for x in cells], T.StructType([T.StructField(f.name, T.StringType()) for f in c.fields]))
    out = apply_contract(raw, c)
    assert out.columns == [*c.names, REASON_COL]
    got = out.collect()
    assert [r[REASON_COL] for r in got][:2] == [None, f"bad_type:{stamps[0].name}"]
    assert got[0][stamps[0].name] is not None and got[1][stamps[0].name] is None
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp(") == len(stamps)


def test_snapshots_are_computed_once(spark):
    """Loads, merges and checks of keys read what was written, not the source again."""
    n = spark.sparkContext.accumulator(0)

    def counting(rows):
        for r in rows:
            n.add(1)
            yield r

    rows = spark.createDataFrame([(i, f"c{i % 3}") for i in range(20)], "k long, city string")
    seen = spark.createDataFrame(rows.rdd.mapPartitions(counting), rows.schema)
    moved = F.when(F.col("k") % 4 == 0, F.lit("moved")).otherwise(F.col("city"))
    t = W._two_snapshots(spark, seen, "city", moved, "k", ["city"], "sk", "once")
    assert n.value == 20
    assert t.read().count() == 25 and t.current().filter("city = 'moved'").count() == 5


def test_staged_rows_merge_like_others(spark, tmp):
    out = []
    for staged in (True, False):
        t = KeyedTable(spark, f"{tmp}/{staged}", "k", n_buckets=4)
        t.load(spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (3, 1, "c")], "k long, ts int, v string"))
        rows = spark.createDataFrame([(1, 2, "new"), (2, 4, "old"), (9, 1, "n")], "k long, ts int, v string")
        touched = t.merge_latest(rows, ["ts"], gone=spark.createDataFrame([(3,)], "k long"), staged=staged)
        out.append((sorted(touched), sorted(map(tuple, t.read().collect()))))
    assert out[0] == out[1]
    assert out[0][1] == [(1, 2, "new"), (2, 5, "b"), (9, 1, "n")]
