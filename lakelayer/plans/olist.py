"""The marketplace pipeline over the eight source contracts, end to end.

bronze: ``plans.bronze.run_all`` (one parameterised job per contract)
silver: clean, deduplicate, check and upsert each source (``silver.silver_upsert``)
gold:   date, customer (SCD2), product (SCD2), seller (SCD1), geography (SCD1)
        dimensions and the order-item fact partitioned by month.

Each layer notes the versions it was built from: silver merges what bronze committed since
the last run, the fact is rewritten for the months of changed orders only.

Every step takes and returns DataFrames or path tables; nothing is collected
except bounded quality reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.functions.keys import surrogate_key
from lakelayer.operators import dq
from lakelayer.operators import merge as M
from lakelayer.operators.lookup import translate
from lakelayer.operators.rollup import latest_per_key, payments_to_order
from lakelayer.operators.stats import grouped_medians
from lakelayer.plans import bronze as B
from lakelayer.plans import gold as G
from lakelayer.plans import silver as SV
from lakelayer.operators import quarantine as Q
from lakelayer.sinks.keyed import BUCKET, STATE, KeyedTable
from lakelayer.sinks.store import BATCH_COL, COMMIT_COL, PathTable

SOURCES = [
    "olist_orders", "olist_order_items", "olist_customers", "olist_products",
    "olist_sellers", "olist_payments", "olist_reviews", "olist_geolocation",
]


def silver_specs() -> dict:
    """Per source: natural key (None: the whole row), zip column, dedup order, string cleaning and quality rules
    (built on call: rules are Spark columns)."""
    return {
        "olist_orders": dict(key=["order_id"], order_by=["purchase_ts"], lower=["order_status"],
                             rules=[dq.Rule.not_null("purchase_ts")]),
        "olist_order_items": dict(key=["order_id", "order_item_id"], order_by=["shipping_limit_ts"],
                                  rules=[dq.Rule.in_range("price", 0, 1e9)]),
        "olist_customers": dict(key=["customer_id"], zip="zip_code", order_by=["customer_unique_id"], trim=["city"], lower=["city"], upper=["state"]),
        "olist_products": dict(key=["product_id"], order_by=["weight_g"], trim=["category_name_pt"]),
        "olist_sellers": dict(key=["seller_id"], zip="zip_code", order_by=["zip_code"], trim=["city"], lower=["city"], upper=["state"]),
        "olist_payments": dict(key=["order_id", "payment_sequential"], order_by=["payment_value"], lower=["payment_type"]),
        "olist_reviews": dict(key=["review_id"], order_by=["answer_ts", "creation_ts"],
                              rules=[dq.Rule.in_range("score", 1, 5)]),
        "olist_geolocation": dict(key=None, zip="zip_code_prefix", order_by=[]),
    }


TECHNICAL = ["_source_file", "_ingested_at", BATCH_COL, "_status", "_quarantine_reason", "_corrupt_record"]


def run_bronze(spark: SparkSession, files: dict[str, str], root: str, batch_id: str) -> dict[str, B.IngestResult]:
    return B.run_all(spark, {n: files[n] for n in SOURCES if n in files}, f"{root}/bronze", batch_id)


#: What decides between rows of one key before the event's own order: the number under
#: which the row's batch was first committed, then the commit that wrote the row (a rerun of
#: a batch keeps its place among the batches and replaces its former rows).
BATCH_ORDER = ["_batch_number", "_commit_number"]
#: Spend bands of marketplace customers, in the currency of the payments.
SPEND_BANDS = [(1000.0, "high"), (200.0, "mid"), (0.0, "low")]


def _bronze_clean(spark, root, name, after: int) -> tuple[DataFrame, int]:
    """Clean rows that bronze committed after its version ``after``, with their place in
    the order of batches, and the version that they reach up to. Neither batch ids nor
    clocks are compared: a batch that is committed late is new, whenever it began."""
    t = PathTable(spark, f"{root}/bronze/{name}")
    version = t.version()
    rows = t.read(version, after=after, with_commit=True).filter(F.col(Q.STATUS_COL) == Q.CLEAN)
    # One row per batch.
    numbers = spark.createDataFrame(sorted(t.batch_numbers().items()) or [], f"{BATCH_COL} string, _batch_number long")
    rows = rows.withColumn(BATCH_COL, F.col(BATCH_COL).cast("string")).join(F.broadcast(numbers), BATCH_COL, "left")
    return rows.withColumnRenamed(COMMIT_COL, "_commit_number").drop(*TECHNICAL), version


def _outdated(spark, root, name, table: KeyedTable, done: int) -> DataFrame | None:
    """Keys whose silver row comes from an earlier run of a batch that has been rerun since;
    the rerun may hold the key no more. None if no merged batch was rerun."""
    bronze = PathTable(spark, f"{root}/bronze/{name}")
    first = bronze.batch_numbers()
    rerun = [(first[b], last) for b, last in bronze.batch_reruns().items() if first[b] <= done < last]
    if not rerun or not table.exists():
        return None
    runs = spark.createDataFrame(rerun, "_batch_number long, _last long")
    rows = table.read().join(F.broadcast(runs), "_batch_number").filter(F.col("_commit_number") < F.col("_last"))
    return rows.select(*table.keys)


def run_silver(spark: SparkSession, root: str, quality_mode: str = "warn", only: list[str] | None = None) -> dict[str, list]:
    """Merge what bronze committed since the last run; ``only`` some sources if named."""
    reports = {}
    for name, spec in silver_specs().items():
        if only is None or name in only:
            reports[name] = _silver_source(spark, root, name, spec, quality_mode)
    return reports


def _silver_source(spark, root, name, spec, quality_mode) -> list:
    def prepared(after: int) -> tuple[DataFrame, int]:
        rows, version = _bronze_clean(spark, root, name, after)
        if spec.get("zip"):
            rows = SV.normalise_zip(rows, spec["zip"])
            rows = rows if spec["zip"] == "zip_code" else rows.drop(spec["zip"])
        return rows, version

    silver_root = f"{root}/silver/{name}"
    done = PathTable(spark, f"{silver_root}/rows").notes().get("bronze_version", 0)
    src, version = prepared(done)
    # Points have no key: the same point in several batches counts once.
    key = spec["key"] or [c for c in src.columns if c not in BATCH_ORDER]
    gone = _outdated(spark, root, name, KeyedTable(spark, silver_root, key), done)
    if gone is not None:
        # What bronze holds of these keys now takes the place of their silver rows.
        every = prepared(0)[0]
        keys = gone.distinct().withColumnsRenamed({k: f"_g_{k}" for k in key})
        again = [every[k].eqNullSafe(keys[f"_g_{k}"]) for k in key]
        src = src.unionByName(every.join(keys, again, "left_semi"))
    _, report = SV.silver_upsert(
        spark, src, key, [*BATCH_ORDER, *spec["order_by"]], silver_root,
        trim=spec.get("trim", ()), lower=spec.get("lower", ()), upper=spec.get("upper", ()),
        rules=spec.get("rules", ()), quality_mode=quality_mode, latest_wins=True, notes={"bronze_version": version}, gone=gone,
    )
    return report


def silver(spark, root, name) -> DataFrame:
    """Current rows of a silver table."""
    return PathTable(spark, f"{root}/silver/{name}/rows").read().drop(STATE, BUCKET, *BATCH_ORDER)


def run_gold(spark: SparkSession, root: str, as_of: str, category_lookup: DataFrame | None = None, lookup_rows: int | None = None) -> dict[str, PathTable]:
    orders = silver(spark, root, "olist_orders")
    items = silver(spark, root, "olist_order_items")
    payments = payments_to_order(
        silver(spark, root, "olist_payments"), "order_id", "payment_value", "payment_type",
        "payment_sequential", installments_col="payment_installments",
    )
    reviews = latest_per_key(silver(spark, root, "olist_reviews"), "order_id", ["score"], ["answer_ts", "review_id"]).select(
        "order_id", F.col("score").alias("review_score")
    )
    tables = {}

    # customers: segment from what their orders paid
    spend = orders.join(payments, "order_id", "inner").select("customer_id", "payment_value")
    customers = SV.spend_segment(silver(spark, root, "olist_customers"), spend, "customer_id", "customer_id", "payment_value", bands=SPEND_BANDS)
    customers = customers.select("customer_id", "customer_unique_id", "city", "state", "zip_code", "segment")
    tables["dim_customer"] = _scd2(spark, f"{root}/gold/dim_customer", customers, "customer_id", ["city", "state", "segment"], as_of, "customer_sk")

    # products: translated category, latest item price
    products = silver(spark, root, "olist_products")
    if category_lookup is not None:
        products = translate(products, category_lookup, "category_name_pt", "category", fallback="code", lookup_rows=lookup_rows)
    else:
        products = products.withColumn("category", F.col("category_name_pt"))
    price = latest_per_key(items, "product_id", ["price"], ["shipping_limit_ts", "order_id", "order_item_id"])
    products = products.join(price.select("product_id", F.col("price").alias("unit_price")), "product_id", "left").select(
        "product_id", F.col("category").alias("name"), "category", "unit_price",
        F.round(F.col("unit_price") * 100).cast("bigint").alias("unit_price_cents"), "weight_g",
    )
    tables["dim_product"] = _scd2(spark, f"{root}/gold/dim_product", products, "product_id", ["category", "unit_price_cents", "weight_g"], as_of, "product_sk")

    sellers = silver(spark, root, "olist_sellers").select("seller_id", "city", "state", "zip_code")
    tables["dim_seller"] = _scd1(spark, f"{root}/gold/dim_seller", sellers, "seller_id", "seller_sk")

    geo = silver(spark, root, "olist_geolocation")
    middle = grouped_medians(geo, ["zip_code"], {"lat": "lat", "lng": "lng"})
    names = geo.groupBy("zip_code").agg(F.max("city").alias("city"), F.max("state").alias("state"))
    geography = names.join(middle, "zip_code", "left")
    tables["dim_geography"] = _scd1(spark, f"{root}/gold/dim_geography", geography, "zip_code", "geo_sk")

    dd = PathTable(spark, f"{root}/gold/dim_date")
    G.write_once(dd, G.dim_date(spark))
    tables["dim_date"] = dd

    o = orders.select(
        "order_id", "customer_id", "order_status", "purchase_ts", "estimated_delivery_ts",
        F.col("customer_delivery_ts").alias("delivered_ts"),
    )
    it = items.select("order_id", "order_item_id", "product_id", "seller_id", F.lit(1).alias("quantity"), "price", "freight_value")

    def build(of: DataFrame) -> DataFrame:
        return G.fact_orders(
            it, of, tables["dim_customer"].read_as_of(), tables["dim_product"].read_as_of(), tables["dim_seller"].read(),
            tables["dim_geography"].read(), payments=payments, reviews=reviews, order_rollup_key="order_id",
            allocate_payments=True,
        )

    ft = PathTable(spark, f"{root}/gold/fact_orders", partition_by=["order_year_month"])
    state = {n: t.version() for n, t in _fact_sources(spark, root, tables).items()}
    G.update_fact(ft, o, _changed_orders(spark, root, tables, ft.notes().get("built_from", {}), orders, items), build, notes={"built_from": state})
    tables["fact_orders"] = ft
    return tables


_ORDER_SOURCES = ["olist_orders", "olist_order_items", "olist_payments", "olist_reviews"]
_FACT_DIMS = {"dim_customer": "customer_id", "dim_product": "product_id", "dim_seller": "seller_id", "dim_geography": None}


def _fact_sources(spark, root, tables) -> dict[str, PathTable]:
    out = {n: PathTable(spark, f"{root}/silver/{n}/rows") for n in _ORDER_SOURCES}
    return out | {n: tables[n].table for n in _FACT_DIMS}


def _changed_orders(spark, root, tables, built_from: dict, orders, items) -> DataFrame | None:
    """Ids of the orders whose fact rows may differ since the versions in ``built_from``:
    those with rows of their own, items, payments or reviews in buckets rewritten since,
    and those of customers, products or sellers in such buckets. None if all may: on the first
    build, and when a geography changed."""
    sources = _fact_sources(spark, root, tables)
    if not built_from or built_from["dim_geography"] != sources["dim_geography"].version():
        return None
    out = spark.createDataFrame([], "order_id string")
    for name in _ORDER_SOURCES:
        t = sources[name]
        if t.version() != built_from[name]:
            out = out.union(t.read(after=built_from[name]).select("order_id"))
    by_customer = _changed_keys(tables, built_from, "dim_customer", "customer_id")
    if by_customer is not None:
        out = out.union(orders.join(by_customer, "customer_id", "left_semi").select("order_id"))
    for dim, key in (("dim_product", "product_id"), ("dim_seller", "seller_id")):
        changed = _changed_keys(tables, built_from, dim, key)
        if changed is not None:
            out = out.union(items.join(changed, key, "left_semi").select("order_id"))
    return out.distinct()


def _changed_keys(tables, built_from, dim: str, key: str) -> DataFrame | None:
    t = tables[dim].table
    return None if t.version() == built_from[dim] else t.read(after=built_from[dim]).select(key).distinct()


def _scd2(spark, path, snapshot, key, tracked, as_of, sk) -> KeyedTable:
    t = KeyedTable(spark, path, key, keep_seen=True)
    if t.exists():
        t.merge_scd2(snapshot, tracked, as_of, sk_col=sk)
    else:
        t.load_scd2(snapshot, tracked, as_of, sk_col=sk)
    return t


def _scd1(spark, path, snapshot, key, sk) -> KeyedTable:
    keyed = snapshot.select(surrogate_key([key], namespace=sk).alias(sk), *snapshot.columns)
    t = KeyedTable(spark, path, key)
    if t.exists():
        t.merge_scd1(keyed)
    else:
        M.assert_unique_keys(keyed, key)
        t.load(keyed)
    return t
