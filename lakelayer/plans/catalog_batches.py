"""Registered queries that run several batches or snapshots, each with its SQL oracle.

The later deliveries derive from the given tables by rules on the integer key, so
SQL can state the expected final state directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.contracts import get_contract
from lakelayer.operators import quarantine as Q
from lakelayer.operators.contract import REASON_COL
from lakelayer.plans import catalog as C
from lakelayer.plans import standins as S
from lakelayer.plans import warehouse as W
from lakelayer.plans.catalog import query
from lakelayer.session import scratch_path
from lakelayer.sinks.store import PathTable

# ------------------------------------------------------------------ sources
@query(
    "scan_csv_by_name",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, CAST(c_nationkey AS INTEGER) AS nation_key,
           c_acctbal AS acctbal, c_mktsegment AS segment, FALSE AS rejected
    FROM customer
    """,
)
def scan_csv_by_name(spark, sf_dir):
    """Two deliveries of one source with different header orders, read by name."""
    from lakelayer.sources.csv import read_csv_contract

    contract = get_contract("customer_raw")
    fields = [f.header for f in contract.fields]
    c = S.load(spark, sf_dir, "customer")
    cells = dict(zip(fields, S.STANDINS["customer"].columns))
    out = None
    for parity, order in ((0, fields), (1, fields[::-1])):
        path = scratch_path(spark, f"by-name-{parity}")
        part = c.filter(F.pmod("c_custkey", F.lit(2)) == parity)
        part.select(*[F.col(cells[h]).cast("string").alias(h) for h in order]).write.option("header", "true").csv(path)
        read = read_csv_contract(spark, path, contract, match_by_name=True)
        out = read if out is None else out.unionByName(read)
    typed = [F.col(f.name).alias(n) for f, n in zip(contract.fields, ("customer_id", "name", "nation_key", "acctbal", "segment"))]
    return out.select(*typed, F.col(REASON_COL).isNotNull().alias("rejected"))


# ------------------------------------------------------------------ bronze
@query(
    "bronze_rerun",
    f"""
    SELECT '001' AS _batch_id, 'clean' AS _status, CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS total_price
    FROM orders
    UNION ALL
    SELECT '002' AS _batch_id, CASE WHEN {S.oracle_reason('orders')} IS NULL THEN 'clean' ELSE 'quarantine' END AS _status,
           CASE WHEN o_orderkey % {S.NULL_KEY_MOD} = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
           CASE WHEN o_orderkey % {S.BAD_NUMBER_MOD} = 0 THEN NULL ELSE o_totalprice END AS total_price
    FROM orders
    """,
)
def bronze_rerun(spark, sf_dir):
    """A dirty batch, another batch, and then the first batch in corrected form: its
    rejects of the first run are gone and the other batch is untouched."""
    from lakelayer.plans import bronze as B

    dirty = S.write_raw_csv(spark, sf_dir, "orders", scratch_path(spark, "raw-orders"))
    corrected = S.write_raw_csv(spark, sf_dir, "orders", scratch_path(spark, "raw-orders"), faults=False)
    root = scratch_path(spark, "bronze-rerun")
    for path, batch in ((dirty, "001"), (dirty, "002"), (corrected, "001")):
        res = B.ingest(spark, "orders_raw", path, root, batch)
    return res.table.read().select("_batch_id", Q.STATUS_COL, "order_id", "total_price")


def _payments_export(spark, sf_dir) -> DataFrame:
    e = S.load(spark, sf_dir, "events").filter("event_type = 'purchase'")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.when(F.col("event_id") % S.NULL_KEY_MOD != 0, F.concat(F.lit("o"), "user_id")).alias("order_id"),
        F.col("event_id").alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        (F.pmod(k, F.lit(4)) + 1).alias("payment_installments"),
        F.when(F.col("event_id") % S.BAD_NUMBER_MOD == 0, F.lit(S.BAD_NUMBER_TEXT)).otherwise(F.col("value").cast("string")).alias("payment_value"),
    )


def _reviews_export(spark, sf_dir) -> DataFrame:
    e = S.load(spark, sf_dir, "events").filter("event_type = 'click'")
    k = F.get_json_object("props", "$.k").cast("int")
    two_lines = F.concat(F.lit('first line, "quoted"\nsecond line '), F.col("event_id").cast("string"))
    return e.select(
        F.when(F.col("event_id") % S.NULL_KEY_MOD != 0, F.concat(F.lit("r"), "event_id")).alias("review_id"),
        F.concat(F.lit("o"), "user_id").alias("order_id"),
        (F.pmod(k, F.lit(5)) + 1).alias("review_score"),
        F.when(F.col("event_id") % 2 == 0, F.lit("a title, short")).alias("review_comment_title"),
        F.when(F.col("event_id") % 3 == 0, two_lines).alias("review_comment_message"),
        F.date_format("ts", S.TS_FORMAT).alias("review_creation_date"),
        F.lit(None).cast("string").alias("review_answer_timestamp"),
    )


def _geolocation_export(spark, sf_dir) -> DataFrame:
    bad = F.col("c_custkey") % S.BAD_NUMBER_MOD == 0
    return S.load(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % S.NULL_KEY_MOD != 0, F.lpad(F.col("c_nationkey").cast("string"), 5, "0")).alias("geolocation_zip_code_prefix"),
        F.when(bad, F.lit(S.BAD_NUMBER_TEXT)).otherwise(F.col("c_acctbal").cast("string")).alias("geolocation_lat"),
        (-F.col("c_acctbal")).alias("geolocation_lng"),
        F.concat(F.lit("city, "), "c_mktsegment").alias("geolocation_city"),
        F.lit("st").alias("geolocation_state"),
    )


def _extra_source_sql(source: str, table: str, where: str, key: str, key_field: str, number: str | None, chars: str) -> str:
    bad = f"WHEN {key} % {S.BAD_NUMBER_MOD} = 0 THEN 'bad_type:{number}'" if number else ""
    return f"""
    SELECT '{source}' AS source, CASE WHEN reason = 'clean' THEN 'clean' ELSE 'quarantine' END AS _status, reason,
           count(*) AS n_rows, CAST(sum(chars) AS BIGINT) AS n_chars
    FROM (SELECT CASE {bad} WHEN {key} % {S.NULL_KEY_MOD} = 0 THEN 'missing_required_field:{key_field}' ELSE 'clean' END AS reason,
                 {chars} AS chars FROM {table} WHERE {where})
    GROUP BY reason"""


_EXTRA = {
    "olist_payments": (_payments_export, "payment_type", ("events", "event_type = 'purchase'", "event_id", "order_id", "payment_value", "7")),
    "olist_reviews": (
        _reviews_export,
        "comment",
        ("events", "event_type = 'click'", "event_id", "review_id", None,
         """CASE WHEN event_id % 3 = 0 THEN length('first line, "quoted"' || chr(10) || 'second line ' || CAST(event_id AS VARCHAR)) ELSE 0 END"""),
    ),
    "olist_geolocation": (_geolocation_export, "city", ("customer", "TRUE", "c_custkey", "zip_code_prefix", "lat", "6 + length(c_mktsegment)")),
}


@query("bronze_marketplace_sources", " UNION ALL ".join(_extra_source_sql(n, *sql) for n, (_, _, sql) in _EXTRA.items()))
def bronze_marketplace_sources(spark, sf_dir):
    """Payments, reviews (quoted line breaks) and geolocation, with headers matched by
    name, through the job that runs all sources."""
    from lakelayer.plans import bronze as B

    root = scratch_path(spark, "bronze-sources")
    paths = {}
    for name, (export, _, _) in _EXTRA.items():
        paths[name] = scratch_path(spark, f"raw-{name}")
        export(spark, sf_dir).write.option("header", "true").option("escape", '"').csv(paths[name])
    out = None
    for name, res in B.run_all(spark, paths, root, "b-0001", match_by_name=True).items():
        counts = (
            res.table.read()
            .groupBy(Q.STATUS_COL, F.coalesce(F.col(REASON_COL), F.lit(Q.CLEAN)).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.length(_EXTRA[name][1])), F.lit(0)).cast("long").alias("n_chars"))
            .select(F.lit(name).alias("source"), Q.STATUS_COL, "reason", "n_rows", "n_chars")
        )
        out = counts if out is None else out.unionByName(counts)
    return out


# ------------------------------------------------------------------ silver
@query(
    "silver_upsert",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice - 1000, 2) ELSE o_totalprice END AS o_totalprice,
           o_orderdate, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS batch_no
    FROM orders
    """,
)
def silver_upsert_q(spark, sf_dir):
    """Two batches: the second one's status is lower in the alphabet, its price lower and its
    event time equal. Then rows of the first batch arrive again and change nothing."""
    from lakelayer.plans.silver import silver_upsert

    o = S.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    third = F.col("o_orderkey") % 3 == 0
    second = o.filter(third).withColumns({"o_orderstatus": F.lit("A"), "o_totalprice": F.round(F.col("o_totalprice") - 1000, 2)})
    late = o.filter(F.col("o_orderkey") % 6 == 0).withColumn("o_orderstatus", F.lit("Z"))
    root = scratch_path(spark, "silver-upsert")
    for rows, batch_no in ((o, 1), (second, 2), (late, 1)):
        table, _ = silver_upsert(
            spark, rows.withColumn("batch_no", F.lit(batch_no)), ["o_orderkey"], ["batch_no", "o_orderdate"], root, latest_wins=True
        )
    return table.read()


@query(
    "dq_null_keys",
    """
    WITH k AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 1000 END AS k, o_orderstatus AS st FROM orders)
    SELECT 'unique:k,st' AS rule, (SELECT count(*) FROM k) AS n_rows,
           (SELECT count(*) FROM k) - (SELECT count(*) FROM (SELECT DISTINCT k, st FROM k)) AS n_failed,
           (SELECT count(*) FROM k) = (SELECT count(*) FROM (SELECT DISTINCT k, st FROM k)) AS passed
    """,
)
def dq_null_keys(spark, sf_dir):
    """The unique rule over a key with NULLs: a repeated key with a NULL counts as repeated."""
    from lakelayer.operators.dq import Rule, report

    k = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") % 1000)
    rows = S.load(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_orderstatus").alias("st"))
    return report(rows, [Rule.unique_key("k", "st")])


# ------------------------------------------------------------------ merges
@query("merge_scd1_rerun", C.ORACLE["merge_scd1"])
def merge_scd1_rerun(spark, sf_dir):
    """The same snapshot merged twice gives the state of one merge."""
    from lakelayer.operators import merge as M

    c = S.load(spark, sf_dir, "customer").select(*C.CUST_COLS)
    t = PathTable(spark, scratch_path(spark, "scd1-rerun"))
    t.overwrite(c)
    for _ in range(2):
        t.overwrite(M.merge_scd1(t.read(), C.customer_next_snapshot(c), "c_custkey"))
    return t.read()


AS_OF_3 = "2024-03-01"
SNAP3_SQL = """
    SELECT c_custkey, c_name, CAST(CASE WHEN c_custkey % 10 = 7 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS INTEGER) AS c_nationkey,
           c_acctbal, c_mktsegment FROM customer"""


@query(
    "merge_scd2_three_snapshots",
    C.SCD2_CTES
    + f""",
    third AS ({C.sql_scd2_enrich(SNAP3_SQL, AS_OF_3, 'c_custkey', C.CUST_TRACKED, C.CUST_COLS, 'customer_sk')}),
    closed3 AS (
        SELECT m.customer_sk, {', '.join('m.' + c for c in C.CUST_COLS)}, m._scd2_hash, m.valid_from,
               CASE WHEN s.c_custkey IS NOT NULL THEN DATE '{AS_OF_3}' - 1 ELSE m.valid_to END AS valid_to,
               m.is_current AND s.c_custkey IS NULL AS is_current
        FROM merged m LEFT JOIN third s ON m.is_current AND s.c_custkey = m.c_custkey AND s._scd2_hash <> m._scd2_hash),
    new3 AS (
        SELECT s.* FROM third s LEFT JOIN merged m ON m.c_custkey = s.c_custkey AND m.is_current
        WHERE m._scd2_hash IS DISTINCT FROM s._scd2_hash)
    SELECT {C.SCD2_COLS_SQL} FROM closed3 UNION ALL SELECT {C.SCD2_COLS_SQL} FROM new3""",
)
def merge_scd2_three_snapshots(spark, sf_dir):
    """Three snapshots, the last one twice: changes go back, others change for the first time."""
    from lakelayer.operators import merge as M

    initial, snap2 = C._scd2_inputs(spark, sf_dir)
    c = S.load(spark, sf_dir, "customer").select(*C.CUST_COLS)
    moved = F.when(F.col("c_custkey") % 10 == 7, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    snap3 = c.withColumn("c_nationkey", moved.cast("int"))
    t = PathTable(spark, scratch_path(spark, "scd2-three"))
    t.overwrite(initial)
    for snapshot, as_of in ((snap2, C.AS_OF_2), (snap3, AS_OF_3), (snap3, AS_OF_3)):
        t.overwrite(M.scd2_merge(t.read(), snapshot, "c_custkey", C.CUST_TRACKED, as_of, sk_col="customer_sk"))
    return t.read()


# ------------------------------------------------------------------ dimensions and fact with history
def _history_sql(rows: str, key: str, sk: str, tracked: list[str], cols: list[str], column: str, value: str, mod: int) -> str:
    """Two versions of the keys that the second snapshot changes, one of the others."""
    changed = [f"'{value}'" if c == column else c for c in cols]
    changed_tracked = [f"'{value}'" if c == column else c for c in tracked]
    return f"""
    SELECT {C.sql_surrogate_key([key, f"DATE '{W.HISTORY_FROM}'"])} AS {sk}, {', '.join(cols)}, {C.sql_change_hash(tracked)} AS _scd2_hash,
           DATE '{W.HISTORY_FROM}' AS valid_from,
           CASE WHEN {key} % {mod} = 0 THEN DATE '{W.HISTORY_CHANGE}' - 1 ELSE DATE '9999-12-31' END AS valid_to,
           {key} % {mod} <> 0 AS is_current
    FROM {rows}
    UNION ALL
    SELECT {C.sql_surrogate_key([key, f"DATE '{W.HISTORY_CHANGE}'"])}, {', '.join(changed)}, {C.sql_change_hash(changed_tracked)},
           DATE '{W.HISTORY_CHANGE}', DATE '9999-12-31', TRUE
    FROM {rows} WHERE {key} % {mod} = 0"""


_CUSTOMER_COLS = ["customer_id", "customer_name", "state", "zip_code", "segment"]
_PRODUCT_COLS = ["product_id", "name", "category", "unit_price", "unit_price_cents", "weight_g"]
HISTORY_CTES = (
    C.WH_CTES
    + f""",
    hist_customer AS ({_history_sql('customers', 'customer_id', 'customer_sk', ['state', 'segment'], _CUSTOMER_COLS, 'segment', 'vip', 3)}),
    hist_product AS ({_history_sql('products', 'product_id', 'product_sk', ['category', 'unit_price_cents', 'weight_g'], _PRODUCT_COLS, 'category', 'clearance', 4)}),
    upserted_seller AS (
        SELECT seller_sk, seller_id, CASE WHEN seller_id % 4 = 0 AND seller_id % 5 <> 0 THEN seller_name || ' renamed' ELSE seller_name END AS seller_name,
               state, zip_code FROM dim_seller
        UNION ALL
        SELECT {C.sql_surrogate_key([f'CAST(seller_id + {C.NEW_KEY_OFFSET} AS BIGINT)'], 'seller')}, seller_id + {C.NEW_KEY_OFFSET}, seller_name, state, zip_code
        FROM dim_seller WHERE seller_id % 7 = 0),
    upserted_geography AS (
        SELECT geo_sk, zip_code, CASE WHEN zip_code % 2 = 0 THEN lower(city) ELSE city END AS city, state, lat, lng FROM dim_geography)
    """
)


@query("dim_customer_history", HISTORY_CTES + "SELECT * FROM hist_customer")
def dim_customer_history(spark, sf_dir):
    return W.dim_customer_history(spark, sf_dir)


@query("dim_product_history", HISTORY_CTES + "SELECT * FROM hist_product")
def dim_product_history(spark, sf_dir):
    return W.dim_product_history(spark, sf_dir)


@query("dim_seller_upsert", HISTORY_CTES + "SELECT * FROM upserted_seller")
def dim_seller_upsert(spark, sf_dir):
    return W.dim_seller_upsert(spark, sf_dir)


@query("dim_geography_upsert", HISTORY_CTES + "SELECT * FROM upserted_geography")
def dim_geography_upsert(spark, sf_dir):
    return W.dim_geography_upsert(spark, sf_dir)


def _as_of(dim: str) -> str:
    return f"""CAST(o.purchase_ts AS DATE) <= {dim}.valid_to
              AND ({dim}.valid_from = DATE '{W.HISTORY_FROM}' OR CAST(o.purchase_ts AS DATE) >= {dim}.valid_from)"""


@query(
    "fact_orders_history",
    HISTORY_CTES
    + f""",
    weights AS (
        SELECT o.customer_id, sum(i.price + i.freight_value) AS w, count(*) AS n
        FROM items i JOIN ord o ON i.order_id = o.order_id GROUP BY o.customer_id)
    SELECT i.order_id, i.order_item_id, dc.customer_sk, dp.product_sk, ds.seller_sk, dg.geo_sk, i.price, p.payment_value,
           round(p.payment_value * CASE WHEN w.w <> 0 THEN (i.price + i.freight_value) / w.w ELSE 1.0 / w.n END, 4) AS payment_value_alloc,
           strftime(o.purchase_ts, '%Y-%m') AS order_year_month
    FROM items i JOIN ord o ON i.order_id = o.order_id
         LEFT JOIN hist_customer dc ON dc.customer_id = o.customer_id AND {_as_of('dc')}
         LEFT JOIN hist_product dp ON dp.product_id = i.product_id AND {_as_of('dp')}
         LEFT JOIN upserted_seller ds ON ds.seller_id = i.seller_id
         LEFT JOIN upserted_geography dg ON dg.zip_code = dc.zip_code
         LEFT JOIN payments p ON p.user_id = o.customer_id
         LEFT JOIN weights w ON w.customer_id = o.customer_id""",
)
def fact_orders_history(spark, sf_dir):
    """The fact over dimensions with two versions, joined as of the purchase date, with
    the payment shared out over the rows it was paid for."""
    f = W.fact_orders_history(spark, sf_dir)
    cols = "order_id order_item_id customer_sk product_sk seller_sk geo_sk price payment_value order_year_month".split()
    return f.select(*cols, F.round("payment_value_alloc", 4).alias("payment_value_alloc"))


# ------------------------------------------------------------------ maintenance: buckets, ranges, months
@query(
    "silver_batches_9_and_10",
    """
    SELECT 'o' || o_orderkey AS order_id,
           CASE WHEN o_orderkey % 7 = 0 THEN 'late' WHEN o_orderkey % 3 = 0 THEN 'delivered'
                WHEN o_orderkey % 2 = 0 THEN 'corrected' ELSE 'shipped' END AS order_status
    FROM orders WHERE o_orderkey % 11 <> 1 OR o_orderkey % 3 = 0 OR o_orderkey % 7 = 0
    """,
)
def silver_batches_9_and_10(spark, sf_dir):
    """Batch 9, then batch 10 (later, though not in the alphabet), a corrected rerun of batch 9
    (keeps its place before 10, and holds some orders no more), and a batch committed last
    under the id of an earlier day."""
    from lakelayer.plans import bronze as B
    from lakelayer.plans import olist

    root = scratch_path(spark, "silver-batches")
    o = S.load(spark, sf_dir, "orders")
    contract = get_contract("olist_orders")

    def deliver(batch_id, rows, status):
        cells = {"order_id": F.concat(F.lit("o"), "o_orderkey"), "customer_id": F.concat(F.lit("c"), "o_custkey"), "order_status": status}
        stamp = F.date_format("o_orderdate", S.TS_FORMAT)
        path = scratch_path(spark, f"raw-batch-{batch_id}")
        rows.select(*[cells.get(f.name, stamp).alias(f.header) for f in contract.fields]).write.option("header", "true").csv(path)
        B.ingest(spark, contract, path, f"{root}/bronze/olist_orders", batch_id)

    deliver("9", o, F.lit("shipped"))
    olist.run_silver(spark, root, only=["olist_orders"])
    deliver("10", o.filter("o_orderkey % 3 = 0"), F.lit("delivered"))
    olist.run_silver(spark, root, only=["olist_orders"])
    deliver("9", o.filter("o_orderkey % 11 <> 1"), F.when(F.col("o_orderkey") % 2 == 0, "corrected").otherwise("shipped"))
    deliver("8", o.filter("o_orderkey % 7 = 0"), F.lit("late"))
    olist.run_silver(spark, root, only=["olist_orders"])
    return olist.silver(spark, root, "olist_orders").select("order_id", "order_status")


ORDERS_MONTH_SQL = f"SELECT {C.ORDERS_COLS}, strftime(o_orderdate, '%Y-%m') AS order_year_month FROM orders"


@query(
    "sink_replace_where",
    f"""
    {ORDERS_MONTH_SQL} WHERE NOT strftime(o_orderdate, '%Y-%m') BETWEEN '1995-03' AND '1995-08'
    UNION ALL
    SELECT * REPLACE ('X' AS o_orderstatus) FROM ({ORDERS_MONTH_SQL}
    WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-03' AND '1995-07')
    """,
)
def sink_replace_where(spark, sf_dir):
    """Six months replaced in one commit by rows of five: the sixth month vanishes."""
    o = C._orders_with_month(spark, sf_dir)
    t = PathTable(spark, scratch_path(spark, "sink-range"), partition_by=["order_year_month"])
    t.overwrite(o)
    new = o.filter(F.col("order_year_month").between("1995-03", "1995-07")).withColumn("o_orderstatus", F.lit("X"))
    t.replace_where(new, "order_year_month BETWEEN '1995-03' AND '1995-08'")
    return t.read().select(*C.ORDERS_COLS.split(", "), F.col("order_year_month").cast("string").alias("order_year_month"))


@query(
    "merge_scd1_buckets",
    """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 100 = 3 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def merge_scd1_buckets(spark, sf_dir):
    """The whole snapshot merged again with one in a hundred customers changed: buckets
    without a change keep their files."""
    from lakelayer.sinks.keyed import KeyedTable

    c = S.load(spark, sf_dir, "customer").select(*C.CUST_COLS)
    t = KeyedTable(spark, scratch_path(spark, "scd1-buckets"), "c_custkey", n_buckets=16)
    t.load(c)
    t.merge_scd1(c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 100 == 3, F.round(F.col("c_acctbal") + 1, 2)).otherwise(F.col("c_acctbal"))))
    return t.read()


@query("merge_scd2_buckets", C.ORACLE["merge_scd2"])
def merge_scd2_buckets(spark, sf_dir):
    """Load and merge of a keyed table: touched buckets rewritten, closed history appended."""
    from lakelayer.sinks.keyed import KeyedTable

    _, snap2 = C._scd2_inputs(spark, sf_dir)
    t = KeyedTable(spark, scratch_path(spark, "scd2-buckets"), "c_custkey", n_buckets=16)
    t.load_scd2(S.load(spark, sf_dir, "customer").select(*C.CUST_COLS), C.CUST_TRACKED, C.AS_OF_1, sk_col="customer_sk")
    t.merge_scd2(snap2, C.CUST_TRACKED, C.AS_OF_2, sk_col="customer_sk")
    return t.read()


@query("merge_scd2_late_snapshot", C.ORACLE["merge_scd2_three_snapshots"])
def merge_scd2_late_snapshot(spark, sf_dir):
    """The snapshots of ``merge_scd2_three_snapshots`` in the order first, third, second: the
    second one is spliced into the history, which comes out the same."""
    from lakelayer.sinks.keyed import KeyedTable

    c = S.load(spark, sf_dir, "customer").select(*C.CUST_COLS)
    moved = F.when(F.col("c_custkey") % 10 == 7, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    t = KeyedTable(spark, scratch_path(spark, "scd2-late"), "c_custkey", n_buckets=16, keep_seen=True)
    t.load_scd2(c, C.CUST_TRACKED, C.AS_OF_1, sk_col="customer_sk")
    t.merge_scd2(c.withColumn("c_nationkey", moved.cast("int")), C.CUST_TRACKED, AS_OF_3, sk_col="customer_sk")
    t.merge_scd2(C.customer_next_snapshot(c), C.CUST_TRACKED, C.AS_OF_2, sk_col="customer_sk")
    return t.read()


SHIFTED_SQL = """CASE WHEN o_orderkey % 40 = 1 OR strftime(o_orderdate, '%Y-%m') = '1994-02' THEN o_orderdate + INTERVAL 31 DAY ELSE o_orderdate END"""


@query(
    "fact_change_set",
    C.WH_CTES
    + f"""SELECT i.order_id, i.order_item_id, i.price, CAST(date_diff('day', CAST(s.purchase_ts AS DATE), CAST(i.delivered_ts AS DATE)) AS INTEGER) AS delivery_days,
       strftime(s.purchase_ts, '%Y-%m') AS order_year_month
       FROM items i JOIN (SELECT o_orderkey AS order_id, {SHIFTED_SQL} AS purchase_ts FROM orders) s ON s.order_id = i.order_id""",
)
def fact_change_set(spark, sf_dir):
    """Some orders move to another month and one month becomes empty: the months that they
    were in or are in now are rewritten, in one commit."""
    from lakelayer.plans import gold as G

    items, orders = W.items(spark, sf_dir), W.orders(spark, sf_dir)
    moves = (F.col("order_id") % 40 == 1) | (F.date_format("purchase_ts", "yyyy-MM") == "1994-02")
    shifted = F.when(moves, F.col("purchase_ts") + F.expr("INTERVAL 31 DAYS")).otherwise(F.col("purchase_ts"))
    after = orders.withColumn("purchase_ts", shifted)

    def build(of):
        return G.order_items(items, of).select("order_id", "order_item_id", "price", "delivery_days", "order_year_month")

    t = PathTable(spark, scratch_path(spark, "fact-changes"), partition_by=["order_year_month"])
    G.update_fact(t, orders, None, build)
    G.update_fact(t, after, orders.filter(moves).select("order_id"), build)
    return t.read()


@query(
    "geo_median_extremes",
    """
    WITH v AS (SELECT c_nationkey, CASE WHEN c_custkey % 11 = 0 THEN 'inf'::DOUBLE WHEN c_custkey % 13 = 0 THEN '-inf'::DOUBLE
                      WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS lat, -c_acctbal AS lng FROM customer)
    SELECT c_nationkey, median(lat) AS lat, median(lng) AS lng FROM v GROUP BY c_nationkey
    """,
)
def geo_median_extremes(spark, sf_dir):
    """Two medians in one pass with infinities and NULLs among the values; groups above
    ten rows go digit by digit."""
    from lakelayer.operators.stats import grouped_medians

    k, inf = F.col("c_custkey"), float("inf")
    lat = F.when(k % 11 == 0, F.lit(inf)).when(k % 13 == 0, F.lit(-inf)).when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_acctbal"))
    c = S.load(spark, sf_dir, "customer").select("c_nationkey", lat.alias("lat"), (-F.col("c_acctbal")).alias("lng"))
    return grouped_medians(c, ["c_nationkey"], {"lat": "lat", "lng": "lng"}, small_group_rows=10)


@query(
    "scan_csv_line_breaks",
    _extra_source_sql("olist_reviews", *_EXTRA["olist_reviews"][2]),
)
def scan_csv_line_breaks(spark, sf_dir):
    """One reviews file with quoted line breaks, read in byte ranges by many tasks."""
    from lakelayer.sources.csv import read_csv_contract

    path = scratch_path(spark, "raw-one-file")
    _reviews_export(spark, sf_dir).coalesce(1).write.option("header", "true").option("escape", '"').csv(path)
    rows = read_csv_contract(spark, path, get_contract("olist_reviews"), match_by_name=True)
    reason = F.coalesce(F.col(REASON_COL), F.lit(Q.CLEAN))
    counts = rows.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.length("comment")), F.lit(0)).cast("long").alias("n_chars")
    )
    status = F.when(F.col("reason") == Q.CLEAN, F.lit(Q.CLEAN)).otherwise(F.lit(Q.QUARANTINE))
    return counts.select(F.lit("olist_reviews").alias("source"), status.alias(Q.STATUS_COL), "reason", "n_rows", "n_chars")


@query(
    "dq_fail_mode",
    """
    SELECT * FROM (VALUES ('fail', 'stopped', 1), ('warn', 'written', 2)) t(mode, outcome, ord)
    CROSS JOIN (SELECT count(*) FILTER (WHERE o_totalprice > 100000) AS n_failed, count(*) AS n_rows FROM orders)
    """.replace("t(mode, outcome, ord)", "t(mode, outcome, position)"),
)
def dq_fail_mode(spark, sf_dir):
    """A rule that fails: in ``fail`` mode the upsert stops and nothing is written, in ``warn``
    mode the report is returned and the rows are written."""
    from lakelayer.operators.dq import DataQualityError, Rule, report
    from lakelayer.plans.silver import silver_upsert
    from lakelayer.sinks.keyed import KeyedTable

    o = S.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rules = [Rule.in_range("o_totalprice", 0, 100000)]
    root, outcomes = scratch_path(spark, "dq-modes"), []
    for position, mode in enumerate(("fail", "warn"), 1):
        try:
            silver_upsert(spark, o, ["o_orderkey"], ["o_totalprice"], root, rules=rules, quality_mode=mode)
        except DataQualityError:
            pass
        outcomes.append((mode, "written" if KeyedTable(spark, root, "o_orderkey").exists() else "stopped", position))
    counted = report(o, rules).select("n_failed", "n_rows")
    out = spark.createDataFrame(outcomes, "mode string, outcome string, position int")
    return out.withColumn("rule", F.lit(rules[0].name)).join(report(o, rules).select("rule", *counted.columns), "rule").drop("rule")


@query(
    "sink_exists",
    """
    SELECT p.priority, count(o_orderkey) > 0 AS table_exists, count(o_orderkey) AS n_rows
    FROM (VALUES ('1-URGENT'), ('3-MEDIUM'), ('5-LOW'), ('9-NEVER')) p(priority) LEFT JOIN orders ON o_orderpriority = p.priority
    GROUP BY p.priority
    """,
)
def sink_exists(spark, sf_dir):
    """One table per priority, written only where there are rows: a table that was never
    written does not exist, and asking for it is no error."""
    o = S.load(spark, sf_dir, "orders")
    root, out = scratch_path(spark, "by-priority"), None
    for priority in ("1-URGENT", "3-MEDIUM", "5-LOW", "9-NEVER"):
        t = PathTable(spark, f"{root}/{priority}")
        rows = o.filter(F.col("o_orderpriority") == priority)
        if not rows.isEmpty():
            t.overwrite(rows)
        n = t.read().agg(F.count(F.lit(1)).alias("n_rows")) if t.exists() else spark.range(1).select(F.lit(0).cast("long").alias("n_rows"))
        found = n.select(F.lit(priority).alias("priority"), F.lit(t.exists()).alias("table_exists"), "n_rows")
        out = found if out is None else out.union(found)
    return out
