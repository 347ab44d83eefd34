"""The star schema built over the driver's tables (stand-ins for the sources).

orders -> orders, lineitem -> order items, customer -> customers, part ->
products, supplier -> sellers, nation/region -> geography (the nation key
plays the zip code), purchase events -> payments and click events -> reviews,
both rolled up per user and joined on ``customer_id = user_id``.

Nothing is collected; the builders with history or upserts write their tables. The SQL in ``plans.catalog``
states the same results independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.functions.keys import surrogate_key
from lakelayer.operators import merge as M
from lakelayer.operators.dedup import dedup_latest
from lakelayer.operators.lookup import DEFAULT_MAX_BROADCAST_ROWS, lookup_table, translate
from lakelayer.operators.rollup import latest_per_key, payments_to_order
from lakelayer.operators.stats import grouped_median
from lakelayer.plans import gold as G
from lakelayer.plans import silver as SV
from lakelayer.plans.standins import load
from lakelayer.session import scratch_path
from lakelayer.sinks.keyed import EFFECTIVE, OPEN_PAST, KeyedTable
from lakelayer.sinks.store import PathTable

AS_OF = "2024-01-01"
ESTIMATED_DELIVERY_DAYS = 30

# Category code -> label (the translation lookup); codes absent
# from it fall back to the lower-cased code.
CATEGORY_LABELS = {
    "ECONOMY": "budget",
    "LARGE": "large goods",
    "MEDIUM": "medium goods",
    "SMALL": "small goods",
    "STANDARD": "standard",
}
# Payment type by the event's property k modulo 4.
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]

# The order items' columns: those taken over, and before them in the order of comparison the
# discount, which decides between shipments that agree in all before it. Columns behind
# the last one taken over cannot change what is taken, so they are not shuffled.
ITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
]
# Surrogate keys as the dimensions make them, for the fact to compute in its last step.
FACT_KEYS = {
    "customer_sk": lambda key, start: surrogate_key([key, start]),
    "product_sk": lambda key, start: surrogate_key([key, start]),
    "seller_sk": lambda key: surrogate_key([key], namespace="seller"),
    "geo_sk": lambda key: surrogate_key([key], namespace="geo"),
}


# ------------------------------------------------------------------ silver
def items(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """Order items, one row per (order_id, order_item_id): the latest shipment wins.
    ``by_order`` leaves them partitioned by order, for a join with the orders."""
    li = load(spark, sf_dir, "lineitem").select(ITEM_COLS)
    deduped = dedup_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], partition_by="l_orderkey" if by_order else None)
    return deduped.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        F.col("l_shipdate").alias("delivered_ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderdate").alias("purchase_ts"),
        F.date_add(F.col("o_orderdate").cast("date"), ESTIMATED_DELIVERY_DAYS).alias("estimated_delivery_ts"),
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    seg = SV.spend_segment(c, load(spark, sf_dir, "orders"), "c_custkey", "o_custkey", "o_totalprice")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = seg.join(n, seg.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("state"),
        F.col("c_nationkey").alias("zip_code"),
        "segment",
    )


def products(spark: SparkSession, sf_dir: str, item_rows: DataFrame | None = None) -> DataFrame:
    p = load(spark, sf_dir, "part")
    lookup, n = lookup_table(spark, CATEGORY_LABELS)
    p = translate(p, lookup, "p_type", "category", lookup_rows=n)
    item_rows = items(spark, sf_dir) if item_rows is None else item_rows
    latest = latest_per_key(item_rows, "product_id", ["unit_price"], ["delivered_ts", "order_id", "order_item_id"])
    j = p.join(latest, p.p_partkey == latest.product_id, "left")
    return j.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        "category",
        "unit_price",
        F.round(F.col("unit_price") * 100).cast("bigint").alias("unit_price_cents"),
        F.col("p_size").alias("weight_g"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.col("n_name").alias("state"),
        F.col("s_nationkey").alias("zip_code"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    k = F.get_json_object("props", "$.k").cast("int")
    ptype = F.element_at(F.array(*[F.lit(t) for t in PAYMENT_TYPES]), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    e = e.withColumn("payment_type", ptype)
    return payments_to_order(e, "user_id", "value", "payment_type", "event_id")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.withColumn("review_score", (F.pmod(k, F.lit(5)) + 1).cast("int"))
    out = latest_per_key(e, "user_id", ["review_score"], ["ts", "event_id"])
    return out.withColumnRenamed("n_rows", "n_reviews")


# ------------------------------------------------------------------ gold
def geo_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median customer balance per nation (the 'lat' stand-in)."""
    c = load(spark, sf_dir, "customer")
    return grouped_median(c, ["c_nationkey"], "c_acctbal", "median_acctbal")


def dim_customer(spark, sf_dir) -> DataFrame:
    return M.scd2_initial(customers(spark, sf_dir), "customer_id", ["state", "segment"], AS_OF, sk_col="customer_sk")


def dim_product(spark, sf_dir, item_rows: DataFrame | None = None) -> DataFrame:
    return M.scd2_initial(
        products(spark, sf_dir, item_rows), "product_id", ["category", "unit_price_cents", "weight_g"], AS_OF, sk_col="product_sk"
    )


# Dates of the two snapshots in the history tables.
HISTORY_FROM = "1995-01-01"
HISTORY_CHANGE = "1996-07-01"


def _stored(spark, df, name) -> DataFrame:
    """``df`` written once to scratch, for several readers."""
    t = PathTable(spark, scratch_path(spark, name), compression="zstd")
    t.overwrite(df)
    return t.read()


def _two_snapshots(spark, snapshot, column, changed, key, tracked, sk, name) -> KeyedTable:
    """In the second snapshot ``column`` is ``changed``. The snapshot is computed once: both
    loads and their checks of the keys read it."""
    first = _stored(spark, snapshot, f"{name}-snapshot")
    t = KeyedTable(spark, scratch_path(spark, name), key, n_buckets=8)
    t.load_scd2(first, tracked, HISTORY_FROM, sk_col=sk)
    t.merge_scd2(first.withColumn(column, changed), tracked, HISTORY_CHANGE, sk_col=sk)
    return t


def customer_history(spark, sf_dir) -> KeyedTable:
    """Two snapshots: in the second one every third customer moves to the segment ``vip``."""
    vip = F.when(F.col("customer_id") % 3 == 0, F.lit("vip")).otherwise(F.col("segment"))
    return _two_snapshots(spark, customers(spark, sf_dir), "segment", vip, "customer_id", ["state", "segment"], "customer_sk", "dim-customer")


def product_history(spark, sf_dir, item_rows: DataFrame | None = None) -> KeyedTable:
    """Two snapshots: in the second one every fourth product moves to ``clearance``."""
    p = products(spark, sf_dir, item_rows)
    clearance = F.when(F.col("product_id") % 4 == 0, F.lit("clearance")).otherwise(F.col("category"))
    tracked = ["category", "unit_price_cents", "weight_g"]
    return _two_snapshots(spark, p, "category", clearance, "product_id", tracked, "product_sk", "dim-product")


def dim_customer_history(spark, sf_dir) -> DataFrame:
    return customer_history(spark, sf_dir).read()


def dim_product_history(spark, sf_dir) -> DataFrame:
    return product_history(spark, sf_dir).read()


def dim_seller_upsert(spark, sf_dir) -> DataFrame:
    """A load, then an upsert in which some sellers are renamed, some are gone and some are new."""
    s = sellers(spark, sf_dir)
    k = F.col("seller_id")
    renamed = F.when(k % 4 == 0, F.concat("seller_name", F.lit(" renamed"))).otherwise(F.col("seller_name"))
    second = s.withColumn("seller_name", renamed).filter(k % 5 != 0)
    second = second.unionByName(s.filter(k % 7 == 0).withColumn("seller_id", k + 1_000_000))
    keyed = [surrogate_key(["seller_id"], namespace="seller").alias("seller_sk"), *s.columns]
    t = KeyedTable(spark, scratch_path(spark, "dim-seller"), "seller_id", n_buckets=8)
    t.load(s.select(*keyed))
    t.merge_scd1(second.select(*keyed))
    return t.read()


def dim_geography_upsert(spark, sf_dir) -> DataFrame:
    """A load, then an upsert that rewrites the names of the even zip codes."""
    t = KeyedTable(spark, scratch_path(spark, "dim-geography"), "zip_code", n_buckets=8)
    t.load(dim_geography(spark, sf_dir))
    even = t.read().filter(F.col("zip_code") % 2 == 0).withColumn("city", F.lower("city"))
    t.merge_scd1(even)
    return t.read()


def dim_seller(spark, sf_dir) -> DataFrame:
    s = sellers(spark, sf_dir)
    return s.select(surrogate_key(["seller_id"], namespace="seller").alias("seller_sk"), *s.columns)


def dim_geography(spark, sf_dir) -> DataFrame:
    n = nations(spark, sf_dir)
    c = load(spark, sf_dir, "customer")
    s = load(spark, sf_dir, "supplier")
    lat = grouped_median(c, ["c_nationkey"], "c_acctbal", "lat")
    lng = grouped_median(s, ["s_nationkey"], "s_acctbal", "lng")
    j = n.join(lat, n.n_nationkey == lat.c_nationkey, "left").join(lng, n.n_nationkey == lng.s_nationkey, "left")
    return j.select(
        surrogate_key(["n_nationkey"], namespace="geo").alias("geo_sk"),
        F.col("n_nationkey").alias("zip_code"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        "lat",
        "lng",
    )


def _fact(spark, sf_dir, item_rows, dim_customer, dim_product, dim_seller, dim_geography, **options) -> DataFrame:
    return G.fact_orders(
        item_rows.drop("unit_price"),
        orders(spark, sf_dir),
        dim_customer,
        dim_product,
        dim_seller,
        dim_geography,
        payments=payments(spark, sf_dir).withColumnRenamed("user_id", "customer_id"),
        reviews=reviews(spark, sf_dir).withColumnRenamed("user_id", "customer_id"),
        order_rollup_key="customer_id",
        small_rows=DEFAULT_MAX_BROADCAST_ROWS,
        keys=FACT_KEYS,
        **options,
    )


def _only_versions(dim: DataFrame) -> DataFrame:
    """A first load: every version is its key's first, so it is open to the past."""
    return dim.withColumn(EFFECTIVE, F.lit(OPEN_PAST).cast("date"))


#: The fact of an input, written once per application.
_WRITTEN: dict[tuple[str, str], PathTable] = {}


def stored_fact(spark, sf_dir) -> PathTable:
    """The fact table partitioned by month. Written when first asked for; later readers of
    the same application read what is there."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN or not _WRITTEN[key].exists():
        # The fact comes clustered by month, sorted by order.
        t = PathTable(spark, scratch_path(spark, "fact-orders"), partition_by=["order_year_month"], rebalance=False, compression="zstd")
        t.overwrite(fact_orders(spark, sf_dir, by_month=True))
        _WRITTEN[key] = t
    return _WRITTEN[key]


def fact_orders(spark, sf_dir, by_month: bool = False) -> DataFrame:
    item_rows = items(spark, sf_dir, by_order=True)
    return _fact(
        spark,
        sf_dir,
        item_rows,
        _only_versions(dim_customer(spark, sf_dir)),
        _only_versions(dim_product(spark, sf_dir, item_rows)),
        dim_seller(spark, sf_dir),
        dim_geography(spark, sf_dir),
        by_month=by_month,
    )


def fact_orders_history(spark, sf_dir) -> DataFrame:
    """The fact over written dimensions: two versions of customers and products, upserted
    sellers and geography, and the payment allocated to the items. The items are written
    once, for the products' prices, the payments' shares and the fact."""
    item_rows = _stored(spark, items(spark, sf_dir), "fact-items")
    return _fact(
        spark,
        sf_dir,
        item_rows,
        customer_history(spark, sf_dir).read_as_of(),
        product_history(spark, sf_dir, item_rows).read_as_of(),
        dim_seller_upsert(spark, sf_dir),
        dim_geography_upsert(spark, sf_dir),
        allocate_payments=True,
    )


def order_items(spark, sf_dir) -> DataFrame:
    return G.order_items(items(spark, sf_dir), orders(spark, sf_dir))
