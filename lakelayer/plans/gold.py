"""Gold layer: a star schema around an order-item fact.

Dimensions
* ``dim_date`` (SCD0): one row per day, built with ``sequence`` + ``explode``
  from a start and end date (by default 2015-01-01 to 2030-12-31, or the span
  of a date column); written once, a later run is a no-op (``write_once``).
* ``dim_customer``, ``dim_product`` (SCD2): ``operators.merge.scd2_*``.
* ``dim_seller``, ``dim_geography`` (SCD1): ``operators.merge.merge_scd1``.

Fact
``fact_orders`` first attaches the order-grain lookups (customer as of the
purchase date with its geography, payments, reviews) to the orders, then joins items
to the enriched orders on the order key (the one large-to-large join: both
sides shuffle on the order key), then looks each item up in the product and
seller dimensions. What is computed of a row alone comes as early as it makes the row
narrower (days between dates) and as late as it makes it wider (surrogate keys), as every
byte of an item is shuffled for each lookup behind it. SCD2 dimensions are joined *as of the purchase date* (key equal
and date inside the version's interval; the first version of a key is open
to the past, since the first load dates every version on the load day). Dimensions
written as keyed tables store that start; only for others is it found by a window.
Spark plans each dimension join by the dimension's bytes, and AQE splits a hot key.
The date key is computed, not joined, because it is a pure function of the date.
The fact is written partitioned by ``order_year_month``; ``update_fact`` rewrites the months
that changed orders were in or are in now.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelayer.functions.calendar import is_br_national_holiday
from lakelayer.functions.keys import surrogate_key
from lakelayer.operators.lookup import bounded_broadcast
from lakelayer.operators.merge import VALID_FROM, VALID_TO
from lakelayer.sinks.keyed import EFFECTIVE, OPEN_PAST
from lakelayer.sinks.store import PathTable

DATE_START = "2015-01-01"
DATE_END = "2030-12-31"


def date_key(date_col: Column) -> Column:
    return surrogate_key([date_col], namespace="date")


def _date_rows(days: DataFrame) -> DataFrame:
    d = F.col("date_id")
    return days.select(
        date_key(d).alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        is_br_national_holiday(d).alias("is_holiday_br"),
    )


def dim_date(spark: SparkSession, start: str | _dt.date = DATE_START, end: str | _dt.date = DATE_END) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("date_id")
    )
    return _date_rows(days)


def dim_date_for(df: DataFrame, date_col: str) -> DataFrame:
    """Days from the first to the last date of ``df[date_col]``; the bounds come
    from one global min/max aggregate, the days from ``sequence`` on that row."""
    span = df.agg(F.min(F.col(date_col).cast("date")).alias("_s"), F.max(F.col(date_col).cast("date")).alias("_e"))
    days = span.select(F.explode(F.sequence("_s", "_e")).alias("date_id"))
    return _date_rows(days)


def write_once(table: PathTable, df: DataFrame) -> bool:
    """SCD0: write only if the table has no committed version. True if written."""
    if table.exists():
        return False
    table.overwrite(df)
    return True


def first_version_open(dim: DataFrame, key: str) -> DataFrame:
    """Add ``_from_eff``: the version start, or the distant past for a key's
    first version. Versions per key are few, so the window is small."""
    w = Window.partitionBy(key).orderBy(F.col(VALID_FROM))
    first = F.row_number().over(w) == 1
    return dim.withColumn("_from_eff", F.when(first, F.lit(OPEN_PAST).cast("date")).otherwise(F.col(VALID_FROM)))


def point_in_time_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_date: str,
    take: list,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Left join each fact row to the dimension version valid on its date.

    The join is an equi join on the key with a range residual. Spark chooses its
    strategy by the dimension's bytes, and AQE splits a hot key on the fact side.
    With ``broadcast_rows`` the dimension is counted first and broadcast up to
    that many rows."""
    opened = dim.withColumn("_from_eff", F.col(EFFECTIVE)) if EFFECTIVE in dim.columns else first_version_open(dim, dim_key)
    d = opened.select(F.col(dim_key).alias("_dk"), "_from_eff", F.col(VALID_TO).alias("_to"), *take)
    if broadcast_rows:
        # The window keeps every row, so the dimension's own count is the
        # size (a footer read for a written table, no window shuffle).
        n = dim.count()
        d = bounded_broadcast(d, max_rows=broadcast_rows, known_rows=n)
    cond = (
        (fact[fact_key] == d["_dk"])
        & (F.col(fact_date).cast("date") >= d["_from_eff"])
        & (F.col(fact_date).cast("date") <= d["_to"])
    )
    return fact.join(d, cond, "left").drop("_dk", "_from_eff", "_to")


def fact_orders(
    items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_geography: DataFrame,
    payments: DataFrame | None = None,
    reviews: DataFrame | None = None,
    order_rollup_key: str = "order_id",
    broadcast_rows: int | None = None,
    allocate_payments: bool = False,
    small_rows: int | None = None,
    keys: dict[str, Callable[..., Column]] | None = None,
    by_month: bool = False,
) -> DataFrame:
    """Order-item fact.

    ``items``: order_id, order_item_id, product_id, seller_id, quantity, price,
    freight_value, delivered_ts. ``orders``: order_id, customer_id, order_status,
    purchase_ts, estimated_delivery_ts. Dimensions carry their natural key
    (customer_id, product_id, seller_id, zip_code) and surrogate key; the
    customer dimension also carries ``zip_code`` for the geography lookup.
    ``payments`` (payment_value, payment_installments, payment_type) and
    ``reviews`` (review_score) are rolled up and keyed by ``order_rollup_key``
    of the orders frame. ``allocate_payments`` adds ``payment_value_alloc``: the
    payment shared over the rows of its key by price and freight (equally where these sum
    to zero), so that a sum over the fact counts it once.

    ``small_rows``: sellers and geography are counted, and broadcast up to that many rows;
    the planner cannot tell their size and would shuffle the fact for them. ``keys``: surrogate
    keys that are a function of the natural key (and, for customers and products, of the
    version's start); rows carry these through the shuffles and the key is computed at the end.
    ``by_month`` clusters the rows by month, and sorts them by order, for a partitioned write, while they are narrow.
    """
    keys = keys or {}

    def counted(df, limit):
        return bounded_broadcast(df, max_rows=limit, known_rows=df.count()) if limit else df

    def taken(sk, key, *start):
        """What the fact takes of a dimension for ``sk``: the key or what makes it."""
        return [F.col(c).alias(f"_{sk}{i}") for i, c in enumerate((key, *start))] if sk in keys else [sk]

    def key_of(sk, n=1):
        if sk not in keys:
            return F.col(sk)
        of = [F.col(f"_{sk}{i}") for i in range(n)]
        # NULL where the lookup found nothing. No ``when``: within its branches Spark would
        # compute the hash once for each of the five parts of the key.
        return F.concat(keys[sk](*of), F.substring(of[0].cast("string"), 1, 0)).alias(sk)

    # Order-grain lookups first: customer (as of the purchase date), its
    # geography, payments and reviews attach to the orders, which are several
    # times fewer and narrower than the items; the geography to the customers, which are
    # fewer still. The items then meet the enriched orders in the one large join, on the
    # order key.
    if EFFECTIVE not in dim_customer.columns:
        dim_customer = first_version_open(dim_customer, "customer_id").withColumnRenamed("_from_eff", EFFECTIVE)
    geo = counted(dim_geography.select(F.col("zip_code").alias("_zip"), *taken("geo_sk", "zip_code")), broadcast_rows or small_rows)
    geo_cols = [c for c in geo.columns if c != "_zip"]
    dim_customer = dim_customer.join(geo, dim_customer["zip_code"] == geo["_zip"], "left").drop("_zip")
    o = point_in_time_join(orders, dim_customer, "customer_id", "customer_id", "purchase_ts", [*taken("customer_sk", "customer_id", VALID_FROM), *geo_cols], broadcast_rows)
    if payments is not None:
        p = payments.select(F.col(order_rollup_key).alias("_pk"), "payment_value", "payment_installments", "payment_type")
        o = o.join(p, o[order_rollup_key] == p["_pk"], "left").drop("_pk")
    else:
        o = o.withColumns({"payment_value": F.lit(None).cast("double"), "payment_installments": F.lit(None).cast("int"), "payment_type": F.lit(None).cast("string")})
    if reviews is not None:
        r = reviews.select(F.col(order_rollup_key).alias("_rk"), "review_score")
        o = o.join(r, o[order_rollup_key] == r["_rk"], "left").drop("_rk")
    else:
        o = o.withColumn("review_score", F.lit(None).cast("int"))
    weight = F.col("price") + F.coalesce(F.col("freight_value"), F.lit(0.0))
    if allocate_payments:
        # Totals attach at order grain too, so the item rows are not shuffled again.
        totals = items.groupBy("order_id").agg(F.sum(weight).alias("_wsum"), F.count(F.lit(1)).alias("_nitems"))
        if order_rollup_key != "order_id":
            of_order = orders.select("order_id", order_rollup_key)
            totals = totals.join(of_order, "order_id").groupBy(order_rollup_key).agg(F.sum("_wsum").alias("_wsum"), F.sum("_nitems").alias("_nitems"))
        o = o.join(totals, order_rollup_key, "left")
    share = F.when(F.col("_wsum") != 0, weight / F.col("_wsum")).otherwise(1.0 / F.col("_nitems"))
    allocated = [(F.col("payment_value") * share).alias("payment_value_alloc")] if allocate_payments else []
    delivery_days, delay_days, _ = _order_measures()
    if "delivered_ts" in items.columns:
        items = items.withColumn("delivered_ts", F.col("delivered_ts").cast("date"))
    customer_cols = [f"_customer_sk{i}" for i in range(2)] if "customer_sk" in keys else ["customer_sk"]
    f = items.join(o, "order_id", "inner").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "quantity",
        "price",
        "freight_value",
        "payment_value",
        *allocated,
        "payment_installments",
        "payment_type",
        "review_score",
        "order_status",
        delivery_days,
        delay_days,
        F.col("purchase_ts").cast("date").alias("_purchased"),
        *customer_cols,
        *geo_cols,
    )
    f = point_in_time_join(f, dim_product, "product_id", "product_id", "_purchased", taken("product_sk", "product_id", VALID_FROM), broadcast_rows)
    seller = counted(dim_seller.select(F.col("seller_id").alias("_sid"), *taken("seller_sk", "seller_id")), broadcast_rows or small_rows)
    f = f.join(seller, f["seller_id"] == seller["_sid"], "left").drop("_sid", "seller_id", "product_id")
    f = f.withColumn("order_year_month", F.date_format("_purchased", "yyyy-MM"))
    if by_month:
        # Rows of an order side by side share most of their values, which the files compress.
        f = f.hint("rebalance", "order_year_month").sortWithinPartitions("order_year_month", "order_id", "order_item_id")
    return f.select(
        surrogate_key(["order_id", "order_item_id"], namespace="order_item").alias("order_sk"),
        key_of("customer_sk", 2),
        key_of("product_sk", 2),
        key_of("seller_sk"),
        date_key(F.col("_purchased")).alias("date_sk"),
        key_of("geo_sk"),
        "order_id",
        "order_item_id",
        "quantity",
        "price",
        "freight_value",
        "payment_value",
        *(["payment_value_alloc"] if allocate_payments else []),
        "payment_installments",
        "payment_type",
        "review_score",
        "order_status",
        "delivery_days",
        "delay_days",
        "order_year_month",
    )


def _order_measures() -> list:
    """Delivery and delay in days, and the month of purchase."""
    delivered = F.col("delivered_ts").cast("date")
    return [
        F.datediff(delivered, F.col("purchase_ts").cast("date")).alias("delivery_days"),
        F.datediff(delivered, F.col("estimated_delivery_ts").cast("date")).alias("delay_days"),
        F.date_format("purchase_ts", "yyyy-MM").alias("order_year_month"),
    ]


def order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The fact's rows with the measures that need no dimension: reports on prices and
    delivery join items and orders only."""
    return items.join(orders, "order_id", "inner").select("order_id", "order_item_id", "price", *_order_measures())


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_year_month").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_distinct("order_id").alias("n_orders"),
        F.round(F.sum("price"), 2).alias("revenue"),
    )


def update_fact(
    table: PathTable,
    orders: DataFrame,
    changed: DataFrame | None,
    build: Callable[[DataFrame], DataFrame],
    notes: dict | None = None,
) -> list[str]:
    """Bring the fact, partitioned by ``order_year_month``, up to date for the ``changed``
    order ids (all if None). Rewritten are the months that hold rows of a changed order
    and those that it is purchased in now, in one commit; a month that becomes empty
    goes, the others keep their files. ``build`` makes the fact of some orders. Returns
    the months (at most as many as the fact has partitions)."""
    if changed is None or not table.exists():
        fact = build(orders)
        table.overwrite(fact, notes)
        return [m.partition("=")[2] for m in table.partitions()]
    month = F.date_format("purchase_ts", "yyyy-MM")
    was = table.read().join(changed, "order_id", "left_semi").select(F.col("order_year_month").cast("string").alias("m"))
    now = orders.join(changed, "order_id", "left_semi").select(month.alias("m"))
    months = sorted(r["m"] for r in was.union(now).filter("m IS NOT NULL").distinct().collect())
    if months:
        gone = {f"order_year_month={m}" for m in months}
        table.commit(build(orders.filter(month.isin(months))), lambda leaf, new: leaf in gone, notes=notes)
    elif notes:
        table.commit(None, lambda leaf, new: False, notes=notes)
    return months


def in_period(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows of the months that ``dates`` (rows of the date dimension, filtered to a
    quarter, a year, holidays ...) touch. The months are known at run time only; Spark
    prunes the fact's partitions by them before it reads (dynamic partition pruning)."""
    months = dates.select(F.date_format("date_id", "yyyy-MM").alias("order_year_month")).distinct()
    return fact.join(F.broadcast(months), "order_year_month", "left_semi")
