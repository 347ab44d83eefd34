"""What the fact's rows carry through its shuffles, and that narrow rows give the same fact."""

import datetime as dt
import re

from pyspark.sql import functions as F

from lakelayer.functions.keys import surrogate_key
from lakelayer.operators import merge as M
from lakelayer.operators.dedup import dedup_latest
from lakelayer.plans import gold as G
from lakelayer.plans import warehouse as W

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def parts(spark):
    """Items of which some find no customer, product, seller or zip code; zip code 1 is there twice."""
    day = dt.datetime(2024, 5, 1, 10)
    items = spark.createDataFrame(
        [(1, 1, 7, 5, 1, 10.0, 1.0, day), (1, 2, 8, 6, 2, 20.0, 2.0, None), (2, 1, 7, None, 1, 5.0, None, day), (3, 1, None, 5, 1, 1.0, 0.0, day)],
        "order_id long, order_item_id int, product_id long, seller_id long, quantity int, price double, freight_value double, delivered_ts timestamp",
    )
    orders = spark.createDataFrame(
        [(1, 100, "F", day, day.date()), (2, 101, "O", dt.datetime(2024, 3, 1), None), (3, 999, "P", None, day.date()), (None, 100, "F", day, None)],
        "order_id long, customer_id long, order_status string, purchase_ts timestamp, estimated_delivery_ts date",
    )
    c = spark.createDataFrame([(100, "x", 1), (101, "y", 2)], "customer_id long, state string, zip_code int")
    customer = M.scd2_initial(c, "customer_id", ["state"], "2024-01-01", sk_col="customer_sk")
    customer = M.scd2_merge(customer, c.withColumn("state", F.lit("z")), "customer_id", ["state"], "2024-04-01", sk_col="customer_sk")
    product = M.scd2_initial(spark.createDataFrame([(7, "p")], "product_id long, category string"), "product_id", ["category"], "2024-01-01", sk_col="product_sk")
    seller = spark.createDataFrame([(5,)], "seller_id long").select(surrogate_key(["seller_id"], namespace="seller").alias("seller_sk"), "seller_id")
    geo = spark.createDataFrame([(1,), (1,)], "zip_code int").select(surrogate_key(["zip_code"], namespace="geo").alias("geo_sk"), "zip_code")
    return items, orders, customer, product, seller, geo


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_keys_computed_at_the_end_are_the_stored_ones(spark):
    stored = G.fact_orders(*parts(spark))
    computed = G.fact_orders(*parts(spark), keys=W.FACT_KEYS, small_rows=1000, by_month=True)
    assert computed.columns == stored.columns
    got = rows(computed)
    assert got == rows(stored) and len(got) == 6
    # Found and not found, for each of the four.
    for sk in W.FACT_KEYS:
        values = [r[computed.columns.index(sk)] for r in got]
        assert None in values and any(v is not None for v in values)


def test_fact_shuffles_carry_no_surrogate_keys(spark):
    text = plan_of(W.fact_orders(spark, SF, by_month=True))
    top = text.index("Exchange")
    assert "sha2" in text[:top] and "sha2" not in text[top:]


def test_sellers_and_geography_do_not_shuffle_the_fact(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(W.fact_orders(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.findall(r"hashpartitioning\((?:seller_id|zip_code|_cust_zip)#", text)


def test_order_columns_are_packed_once(spark):
    df = spark.createDataFrame([(1, "b", 2, "x"), (1, "a", 3, "y"), (1, "c", 3, None), (2, None, None, "z"), (None, "n", 1, "w")], "k int, a string, ts int, b string")
    out = dedup_latest(df, ["k"], ["ts", "a"])
    assert out.columns == df.columns
    assert rows(out) == rows(spark.createDataFrame([(1, "c", 3, None), (2, None, None, "z"), (None, "n", 1, "w")], df.schema))
    packed = re.search(r"struct\(([^)]*)\)", plan_of(out)).group(1)
    assert packed.count("#") == 3


def test_stored_fact_is_compact_and_whole(spark):
    """A quarter of the stored fact has the rows of the fact itself; its files are zstd, one to a month."""
    import pyarrow.parquet as pq

    from lakelayer.plans.catalog import QUERIES

    months = ["1997-10", "1997-11", "1997-12"]
    quarter = QUERIES["fact_quarter_pruned"](spark, SF)
    fact = W.fact_orders(spark, SF).filter(F.col("order_year_month").isin(months))
    assert rows(quarter.select(*fact.columns)) == rows(fact) != []
    t = W.stored_fact(spark, SF)
    files = [f.removeprefix("file://") for f in t.read().inputFiles()]
    assert len(files) == len(t.partitions())
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_items_are_shuffled_once_up_to_the_order_join(spark):
    """The shuffle that removes duplicates serves the join with the orders too."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(W.fact_orders(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"hashpartitioning\(((?:l_orderkey|l_linenumber|order_id)#[^)]*), \d+\)", text)
    assert [re.sub(r"#\d+L?", "", k) for k in keys] == ["l_orderkey", "order_id"]


def test_items_by_order_are_the_same_items(spark, tmp):
    day = dt.datetime(2024, 5, 1)
    li = [(1, 7, 5, 1, 2.0, 10.0, 0.1, 0.0, day), (1, 8, 5, 1, 2.0, 10.0, 0.1, 0.0, day), (1, 7, 5, 2, 1.0, 5.0, None, 0.1, None), (None, 7, 5, 1, 1.0, 1.0, 0.0, 0.0, day)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    spark.createDataFrame(li + li[2:], schema).write.parquet(f"{tmp}/lineitem.parquet")
    plain, by_order = W.items(spark, tmp), W.items(spark, tmp, by_order=True)
    assert by_order.columns == plain.columns
    assert rows(by_order) == rows(plain) and by_order.count() == 3


def test_stored_fact_is_sorted_by_order(spark):
    import pyarrow.parquet as pq

    files = [f.removeprefix("file://") for f in W.stored_fact(spark, SF).read().inputFiles()]
    for f in files:
        # A file alone: the folders' names are not read as columns.
        t = pq.ParquetFile(f).read(["order_id", "order_item_id"])
        keys = list(zip(t["order_id"].to_pylist(), t["order_item_id"].to_pylist()))
        assert keys == sorted(keys)
    assert files
