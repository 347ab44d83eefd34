"""Registered queries over the driver's tables, each with its SQL oracle.

Every query reads whole tables of ``sf_dir`` (or files Spark derives from
them in the session's shared checkpoint folder) and returns a DataFrame.
``ORACLE`` holds, per query, SQL that DuckDB runs over the same tables to state
the expected result independently. Column names are aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.contracts import get_contract
from lakelayer.operators import quarantine as Q
from lakelayer.operators.contract import CORRUPT_COL, REASON_COL, apply_contract
from lakelayer.plans import standins as S
from lakelayer.session import scratch_path
from lakelayer.sources.csv import read_csv_contract
from lakelayer.sources.readers import read_json, read_parquet, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco


# ------------------------------------------------------------------ helpers
def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed contract read of the fault-injected orders export."""
    path = S.write_raw_csv(spark, sf_dir, "orders", scratch_path(spark, "raw-orders"))
    return read_csv_contract(spark, path, get_contract("orders_raw"))


ORDERS_FIELDS = "order_id, customer_id, order_status, total_price, purchase_ts, priority"


# ------------------------------------------------------------------ sources
@query(
    "scan_csv_contract",
    f"""
    SELECT {S.oracle_typed_select('orders', include_reason=False)},
           (o_orderkey % {S.RAGGED_MOD} = 0) AS is_malformed
    FROM orders
    """,
)
def scan_csv_contract(spark, sf_dir):
    df = dirty_orders(spark, sf_dir)
    return df.select(*ORDERS_FIELDS.split(", "), F.col(CORRUPT_COL).isNotNull().alias("is_malformed"))


@query(
    "scan_csv_corrupt",
    f"""
    SELECT CASE WHEN o_orderkey % {S.NULL_KEY_MOD} = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
           7 AS n_fields,
           '{S.RAGGED_TAIL}' AS last_field
    FROM orders WHERE o_orderkey % {S.RAGGED_MOD} = 0
    """,
)
def scan_csv_corrupt(spark, sf_dir):
    df = dirty_orders(spark, sf_dir)
    parts = F.split(F.col(CORRUPT_COL), ",")
    return df.filter(F.col(CORRUPT_COL).isNotNull()).select(
        "order_id",
        F.size(parts).alias("n_fields"),
        F.element_at(parts, -1).alias("last_field"),
    )


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return read_parquet(spark, S.table_path(sf_dir, "orders"))


@query("scan_json", "SELECT * FROM orders")
def scan_json(spark, sf_dir):
    path = scratch_path(spark, "json-orders")
    orders = S.load(spark, sf_dir, "orders")
    orders.write.mode("overwrite").json(path)
    return read_json(spark, path, schema=orders.schema)


@query("scan_table", "SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_table(spark, sf_dir):
    import uuid

    path = scratch_path(spark, "table-nation")
    S.load(spark, sf_dir, "nation").write.mode("overwrite").parquet(path)
    name = f"nation_{uuid.uuid4().hex[:8]}"
    spark.catalog.createTable(name, path=path, source="parquet")
    region = S.load(spark, sf_dir, "region")
    return read_table(spark, name).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name"
    )


# ------------------------------------------------------------------ contract + quarantine
@query(
    "apply_contract",
    f"SELECT {S.oracle_typed_select('orders', include_reason=True, ragged=False)} FROM orders",
)
def apply_contract_q(spark, sf_dir):
    raw = S.raw_frame(spark, sf_dir, "orders")
    return apply_contract(raw, get_contract("orders_raw"))


@query(
    "quarantine_clean",
    f"""
    SELECT {ORDERS_FIELDS}
    FROM (SELECT {S.oracle_typed_select('orders')} FROM orders)
    WHERE _quarantine_reason IS NULL
    """,
)
def quarantine_clean(spark, sf_dir):
    return Q.clean_rows(dirty_orders(spark, sf_dir))


@query(
    "quarantine_rejects",
    f"""
    SELECT {ORDERS_FIELDS}, _quarantine_reason
    FROM (SELECT {S.oracle_typed_select('orders')} FROM orders)
    WHERE _quarantine_reason IS NOT NULL
    """,
)
def quarantine_rejects(spark, sf_dir):
    return Q.rejected_rows(dirty_orders(spark, sf_dir)).drop(CORRUPT_COL)


@query(
    "quarantine_reason",
    f"""
    SELECT order_id,
           CASE WHEN _quarantine_reason LIKE 'bad_type:%' THEN 'malformed_record'
                ELSE _quarantine_reason END AS _quarantine_reason
    FROM (SELECT {S.oracle_typed_select('orders')} FROM orders)
    WHERE _quarantine_reason IS NOT NULL
    """,
)
def quarantine_reason(spark, sf_dir):
    """The two-reason scheme of a typed PERMISSIVE read: a cell failing its type
    makes the row malformed; then missing required fields, in schema order."""
    typed = dirty_orders(spark, sf_dir)
    contract = get_contract("orders_raw")
    as_typed_read = typed.withColumn(
        CORRUPT_COL,
        F.when(F.col(REASON_COL).startswith("bad_type:"), F.lit("<bad cell>")).otherwise(F.col(CORRUPT_COL)),
    ).drop(REASON_COL)
    routed = Q.route(as_typed_read, contract.typed_schema())
    return Q.rejected_rows(routed).select("order_id", REASON_COL)


@query(
    "quarantine_counts",
    f"""
    SELECT COALESCE(r, 'clean') AS reason, COUNT(*) AS n_rows
    FROM (SELECT {S.oracle_reason('orders')} AS r FROM orders) GROUP BY 1
    """,
)
def quarantine_counts(spark, sf_dir):
    return Q.reason_counts(dirty_orders(spark, sf_dir))


@query(
    "case_reason",
    f"""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % {S.RAGGED_MOD} = 0 THEN 'malformed_record'
                WHEN o_orderkey % {S.NULL_KEY_MOD} = 0 THEN 'missing_required_field:order_id'
                WHEN o_orderpriority LIKE '5%' THEN 'missing_required_field:priority'
           END AS _quarantine_reason
    FROM orders
    """,
)
def case_reason(spark, sf_dir):
    """The reason expression on an already typed frame: corrupt marker first,
    then required columns in order."""
    o = S.load(spark, sf_dir, "orders")
    framed = o.select(
        "o_orderkey",
        F.when(o.o_orderkey % S.NULL_KEY_MOD != 0, o.o_orderkey.cast("string")).alias("order_id"),
        F.when(~o.o_orderpriority.startswith("5"), o.o_orderpriority).alias("priority"),
        F.when(o.o_orderkey % S.RAGGED_MOD == 0, F.lit("raw line")).alias(CORRUPT_COL),
    )
    return Q.route(framed, ["order_id", "priority"]).select("o_orderkey", REASON_COL)


# ------------------------------------------------------------------ bronze jobs
BRONZE_TABLES = ("orders", "customer", "part", "supplier", "lineitem")
BATCH = "b-0001"


def _bronze_counts_sql(name: str) -> str:
    r = S.oracle_reason(name)
    return f"""
    SELECT '{S.STANDINS[name].contract}' AS source,
           CASE WHEN r IS NULL THEN 'clean' ELSE 'quarantine' END AS _status,
           COALESCE(r, 'clean') AS reason, COUNT(*) AS n_rows
    FROM (SELECT {r} AS r FROM {name}) GROUP BY 1, 2, 3"""


@query("bronze_ingest", " UNION ALL ".join(_bronze_counts_sql(n) for n in BRONZE_TABLES))
def bronze_ingest(spark, sf_dir):
    from lakelayer.plans import bronze as B

    root = scratch_path(spark, "bronze")
    out = None
    for name in BRONZE_TABLES:
        s = S.STANDINS[name]
        raw = S.write_raw_csv(spark, sf_dir, name, scratch_path(spark, f"raw-{name}"))
        res = B.ingest(spark, s.contract, raw, f"{root}/{s.contract}", BATCH)
        counts = (
            res.table.read()
            .groupBy(Q.STATUS_COL, F.coalesce(F.col(REASON_COL), F.lit(Q.CLEAN)).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(s.contract).alias("source"), Q.STATUS_COL, "reason", "n_rows")
        )
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "bronze_technical",
    f"""
    SELECT '{BATCH}' AS _batch_id,
           CASE WHEN r IS NULL THEN 'clean' ELSE 'quarantine' END AS _status,
           COUNT(*) AS n_rows, COUNT(*) AS n_source_file, COUNT(*) AS n_ingested_at,
           CAST(1 AS BIGINT) AS n_batches
    FROM (SELECT {S.oracle_reason('orders')} AS r FROM orders) GROUP BY 1, 2
    """,
)
def bronze_technical(spark, sf_dir):
    """Technical columns, and idempotence: the batch is ingested twice."""
    from lakelayer.plans import bronze as B

    raw = S.write_raw_csv(spark, sf_dir, "orders", scratch_path(spark, "raw-orders"))
    root = scratch_path(spark, "bronze-orders")
    B.ingest(spark, "orders_raw", raw, root, BATCH)
    res = B.ingest(spark, "orders_raw", raw, root, BATCH)
    return (
        res.table.read()
        .groupBy("_batch_id", Q.STATUS_COL)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("_source_file").alias("n_source_file"),
            F.count(B.INGESTED_AT).alias("n_ingested_at"),
            F.count_distinct(B.INGESTED_AT).alias("n_batches"),
        )
    )


# ------------------------------------------------------------------ sinks
def _orders_with_month(spark, sf_dir):
    o = S.load(spark, sf_dir, "orders")
    return o.withColumn("order_year_month", F.date_format("o_orderdate", "yyyy-MM"))


ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query(
    "sink_append",
    f"""
    SELECT {ORDERS_COLS}, CASE WHEN year(o_orderdate) < 1998 THEN 'b1' ELSE 'b2' END AS _batch_id
    FROM orders
    """,
)
def sink_append(spark, sf_dir):
    """Two batches appended, the second one twice: the rerun replaces itself."""
    from lakelayer.sinks.store import PathTable

    o = S.load(spark, sf_dir, "orders")
    t = PathTable(spark, scratch_path(spark, "sink-append"))
    t.append(o.filter(F.year("o_orderdate") < 1998), batch_id="b1")
    t.append(o.filter(F.year("o_orderdate") >= 1998), batch_id="b2")
    t.append(o.filter(F.year("o_orderdate") >= 1998), batch_id="b2")
    return t.read().select(*ORDERS_COLS.split(", "), "_batch_id")


@query("sink_overwrite", f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderstatus = 'F'")
def sink_overwrite(spark, sf_dir):
    from lakelayer.sinks.store import PathTable

    o = S.load(spark, sf_dir, "orders")
    t = PathTable(spark, scratch_path(spark, "sink-overwrite"))
    t.overwrite(o)
    t.overwrite(o.filter(F.col("o_orderstatus") == "F"))
    return t.read().select(*ORDERS_COLS.split(", "))


@query(
    "sink_overwrite_partition",
    f"""
    SELECT {ORDERS_COLS}, strftime(o_orderdate, '%Y-%m') AS order_year_month
    FROM orders WHERE year(o_orderdate) <> 1996
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice,
           o_orderdate, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS order_year_month
    FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'F'
    """,
)
def sink_overwrite_partition(spark, sf_dir):
    """Months of 1996 replaced by a revised frame; an empty frame changes nothing;
    every other month is kept as written."""
    from lakelayer.sinks.store import PathTable

    o = _orders_with_month(spark, sf_dir)
    t = PathTable(spark, scratch_path(spark, "sink-partition"), partition_by=["order_year_month"])
    t.overwrite(o)
    revised = o.filter((F.year("o_orderdate") == 1996) & (F.col("o_orderstatus") == "F")).withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") * 2, 2)
    )
    t.overwrite_partitions(revised)
    t.overwrite_partitions(revised.limit(0))
    return t.read().select(*ORDERS_COLS.split(", "), F.col("order_year_month").cast("string").alias("order_year_month"))


@query("distinct_partitions", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS order_year_month FROM orders")
def distinct_partitions(spark, sf_dir):
    return _orders_with_month(spark, sf_dir).select("order_year_month").distinct()


# ------------------------------------------------------------------ merges (SCD1 / SCD2)
AS_OF_1 = "2024-01-01"
AS_OF_2 = "2024-02-01"
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUST_TRACKED = ["c_nationkey", "c_mktsegment"]
NEW_KEY_OFFSET = 1_000_000


def customer_next_snapshot(c: DataFrame) -> DataFrame:
    """Next full snapshot: keys ending in 0 change segment (tracked) and balance,
    keys ending in 3 change balance only (untracked), keys ending in 9 vanish,
    keys ending in 5 are copied under a new key."""
    k = F.col("c_custkey")
    changed = c.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(k % 10 == 0, F.col("c_acctbal") + 100)
        .when(k % 10 == 3, F.col("c_acctbal") + 1)
        .otherwise(F.col("c_acctbal"))
        .alias("c_acctbal"),
        F.when(k % 10 == 0, F.lit("RETAIL")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    ).filter(k % 10 != 9)
    new = c.filter(k % 10 == 5).select(
        (k + NEW_KEY_OFFSET).alias("c_custkey"),
        F.concat("c_name", F.lit("-new")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )
    return changed.unionByName(new)


SNAP2_SQL = f"""
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 100
                WHEN c_custkey % 10 = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_custkey % 10 = 0 THEN 'RETAIL' ELSE c_mktsegment END AS c_mktsegment
    FROM customer WHERE c_custkey % 10 <> 9
    UNION ALL
    SELECT c_custkey + {NEW_KEY_OFFSET}, c_name || '-new', c_nationkey, c_acctbal, c_mktsegment
    FROM customer WHERE c_custkey % 10 = 5"""


def sql_canon(expr: str) -> str:
    return f"COALESCE(CAST(length(CAST({expr} AS VARCHAR)) AS VARCHAR) || ':' || CAST({expr} AS VARCHAR), '~')"


def sql_change_hash(cols: list[str]) -> str:
    return "sha256(concat_ws('|', " + ", ".join(sql_canon(c) for c in cols) + "))"


def sql_uuid_shape(h: str) -> str:
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
        f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)"
    )


def sql_surrogate_key(cols: list[str], namespace: str = "") -> str:
    parts = ([f"'{namespace}'"] if namespace else []) + [sql_canon(c) for c in cols]
    return sql_uuid_shape("sha256(concat_ws('|', " + ", ".join(parts) + "))")


def sql_scd2_enrich(src: str, as_of: str, key: str, tracked: list[str], cols: list[str], sk: str) -> str:
    return f"""
    SELECT {sql_surrogate_key([key, f"DATE '{as_of}'"])} AS {sk}, {', '.join(cols)},
           {sql_change_hash(tracked)} AS _scd2_hash, DATE '{as_of}' AS valid_from,
           DATE '9999-12-31' AS valid_to, TRUE AS is_current
    FROM ({src})"""


SCD2_COLS_SQL = "customer_sk, " + ", ".join(CUST_COLS) + ", _scd2_hash, valid_from, valid_to, is_current"
SCD2_CTES = f"""
WITH snap2 AS ({SNAP2_SQL}),
initial AS ({sql_scd2_enrich('SELECT * FROM customer', AS_OF_1, 'c_custkey', CUST_TRACKED, CUST_COLS, 'customer_sk')}),
enriched AS ({sql_scd2_enrich('SELECT * FROM snap2', AS_OF_2, 'c_custkey', CUST_TRACKED, CUST_COLS, 'customer_sk')}),
closed AS (
    SELECT t.customer_sk, {', '.join('t.' + c for c in CUST_COLS)}, t._scd2_hash, t.valid_from,
           CASE WHEN s.c_custkey IS NOT NULL AND t.is_current AND s._scd2_hash <> t._scd2_hash
                THEN DATE '{AS_OF_2}' - 1 ELSE t.valid_to END AS valid_to,
           CASE WHEN s.c_custkey IS NOT NULL AND t.is_current AND s._scd2_hash <> t._scd2_hash
                THEN FALSE ELSE t.is_current END AS is_current
    FROM initial t LEFT JOIN enriched s ON s.c_custkey = t.c_custkey),
new_versions AS (
    SELECT s.* FROM enriched s LEFT JOIN initial t ON t.c_custkey = s.c_custkey AND t.is_current
    WHERE t._scd2_hash IS DISTINCT FROM s._scd2_hash),
merged AS (
    SELECT {SCD2_COLS_SQL} FROM closed UNION ALL SELECT {SCD2_COLS_SQL} FROM new_versions)
"""


def _scd2_inputs(spark, sf_dir):
    from lakelayer.operators import merge as M

    c = S.load(spark, sf_dir, "customer").select(*CUST_COLS)
    initial = M.scd2_initial(c, "c_custkey", CUST_TRACKED, AS_OF_1, sk_col="customer_sk")
    return initial, customer_next_snapshot(c)


@query(
    "merge_scd1",
    f"""
    WITH snap2 AS ({SNAP2_SQL})
    SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM snap2 s WHERE s.c_custkey = t.c_custkey)
    UNION ALL SELECT * FROM snap2
    """,
)
def merge_scd1_q(spark, sf_dir):
    """Upsert of the next snapshot into a path table, committed as a new version."""
    from lakelayer.operators import merge as M
    from lakelayer.sinks.store import PathTable

    c = S.load(spark, sf_dir, "customer").select(*CUST_COLS)
    t = PathTable(spark, scratch_path(spark, "scd1-customer"))
    t.overwrite(c)
    t.overwrite(M.merge_scd1(t.read(), customer_next_snapshot(c), "c_custkey"))
    return t.read()


@query("scd2_enrich", SCD2_CTES + f"SELECT {SCD2_COLS_SQL} FROM enriched")
def scd2_enrich_q(spark, sf_dir):
    from lakelayer.operators import merge as M

    _, snap2 = _scd2_inputs(spark, sf_dir)
    return M.scd2_enrich(snap2, "c_custkey", CUST_TRACKED, AS_OF_2, sk_col="customer_sk")


@query("scd2_initial", SCD2_CTES + f"SELECT {SCD2_COLS_SQL} FROM initial")
def scd2_initial_q(spark, sf_dir):
    initial, _ = _scd2_inputs(spark, sf_dir)
    return initial


@query("scd2_close", SCD2_CTES + f"SELECT {SCD2_COLS_SQL} FROM closed")
def scd2_close_q(spark, sf_dir):
    from lakelayer.operators import merge as M

    initial, snap2 = _scd2_inputs(spark, sf_dir)
    return M.scd2_close(initial, snap2, "c_custkey", CUST_TRACKED, AS_OF_2, sk_col="customer_sk")


@query("scd2_new_versions", SCD2_CTES + f"SELECT {SCD2_COLS_SQL} FROM new_versions")
def scd2_new_versions_q(spark, sf_dir):
    from lakelayer.operators import merge as M

    initial, snap2 = _scd2_inputs(spark, sf_dir)
    return M.scd2_new_versions(initial, snap2, "c_custkey", CUST_TRACKED, AS_OF_2, sk_col="customer_sk")


@query("merge_scd2", SCD2_CTES + f"SELECT {SCD2_COLS_SQL} FROM merged")
def merge_scd2_q(spark, sf_dir):
    """Initial load then one merge, each committed as a version of a path table."""
    from lakelayer.operators import merge as M
    from lakelayer.sinks.store import PathTable

    initial, snap2 = _scd2_inputs(spark, sf_dir)
    t = PathTable(spark, scratch_path(spark, "scd2-customer"))
    t.overwrite(initial)
    t.overwrite(M.scd2_merge(t.read(), snap2, "c_custkey", CUST_TRACKED, AS_OF_2, sk_col="customer_sk", validate=True))
    return t.read()


@query("scd2_current", SCD2_CTES + "SELECT c_custkey, customer_sk FROM merged WHERE is_current")
def scd2_current_q(spark, sf_dir):
    from lakelayer.operators import merge as M

    initial, snap2 = _scd2_inputs(spark, sf_dir)
    merged = M.scd2_merge(initial, snap2, "c_custkey", CUST_TRACKED, AS_OF_2, sk_col="customer_sk")
    return M.scd2_current_keys(merged, "c_custkey", ["customer_sk"])


# ------------------------------------------------------------------ scalars
@query(
    "scalar_hash",
    f"""
    SELECT c_custkey,
           sha256(concat_ws('|', c_name, c_mktsegment)) AS concat_hash,
           {sql_change_hash(['c_nationkey', 'c_mktsegment', 'c_name'])} AS safe_hash
    FROM customer
    """,
)
def scalar_hash(spark, sf_dir):
    from lakelayer.functions.hashing import change_hash

    c = S.load(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        change_hash(["c_name", "c_mktsegment"], mode="concat").alias("concat_hash"),
        change_hash(["c_nationkey", "c_mktsegment", "c_name"]).alias("safe_hash"),
    )


@query(
    "scalar_date",
    f"""
    SELECT o_orderkey,
           CAST(o_orderdate AS DATE) - 1 AS day_before,
           DATE '9999-12-31' AS open_end,
           DATE '{AS_OF_2}' - 1 AS closed_at,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF_2}') AS INTEGER) AS age_days
    FROM orders
    """,
)
def scalar_date(spark, sf_dir):
    o = S.load(spark, sf_dir, "orders")
    as_of = F.lit(AS_OF_2).cast("date")
    return o.select(
        "o_orderkey",
        F.date_sub(F.col("o_orderdate").cast("date"), 1).alias("day_before"),
        F.lit("9999-12-31").cast("date").alias("open_end"),
        F.date_sub(as_of, 1).alias("closed_at"),
        F.datediff(as_of, F.col("o_orderdate").cast("date")).alias("age_days"),
    )


@query("surrogate_key", f"SELECT c_custkey, {sql_surrogate_key(['c_custkey'], 'customer')} AS customer_sk FROM customer")
def surrogate_key_q(spark, sf_dir):
    from lakelayer.functions.keys import surrogate_key

    c = S.load(spark, sf_dir, "customer")
    return c.select("c_custkey", surrogate_key(["c_custkey"], namespace="customer").alias("customer_sk"))


# ------------------------------------------------------------------ silver
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
DEDUP_ORDER_SQL = "l_shipdate DESC, " + ", ".join(
    f"{c} DESC" for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber", "l_shipdate")
)
DEDUP_SQL = f"""
    SELECT {', '.join(LINEITEM_COLS)} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {DEDUP_ORDER_SQL}) AS rn
        FROM lineitem) WHERE rn = 1"""


@query("silver_dedup", DEDUP_SQL)
def silver_dedup(spark, sf_dir):
    from lakelayer.operators.dedup import dedup_latest

    return dedup_latest(S.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "silver_clean",
    """
    SELECT c_custkey, NULLIF(trim(c_name), '') AS c_name, c_nationkey, c_acctbal,
           NULLIF(lower(trim(c_mktsegment)), '') AS c_mktsegment
    FROM customer
    """,
)
def silver_clean(spark, sf_dir):
    from lakelayer.plans.silver import clean_strings

    c = S.load(spark, sf_dir, "customer")
    return clean_strings(c, trim=["c_name", "c_mktsegment"], lower=["c_mktsegment"])


DQ_RULES_SQL = [
    ("positive:l_quantity", "l_quantity IS NULL OR l_quantity <= 0"),
    ("in_range:l_discount", "l_discount IS NULL OR l_discount < 0 OR l_discount > 0.1"),
    ("in_range:l_tax", "l_tax IS NULL OR l_tax < 0 OR l_tax > 0.08"),
    ("in_set:l_returnflag", "l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N', 'R')"),
    ("not_null:l_shipdate", "l_shipdate IS NULL"),
]


def _dq_sql() -> str:
    aggs = ", ".join(f"count(*) FILTER (WHERE {cond}) AS f{i}" for i, (_, cond) in enumerate(DQ_RULES_SQL))
    base = f"""WITH c AS (SELECT count(*) AS n_rows, {aggs},
        count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS fu FROM lineitem)"""
    parts = [f"SELECT '{name}' AS rule, n_rows, f{i} AS n_failed, f{i} = 0 AS passed FROM c" for i, (name, _) in enumerate(DQ_RULES_SQL)]
    parts.append("SELECT 'unique:l_orderkey,l_linenumber' AS rule, n_rows, fu AS n_failed, fu = 0 AS passed FROM c")
    return base + "\n" + "\nUNION ALL ".join(parts)


@query("dq_report", _dq_sql())
def dq_report_q(spark, sf_dir):
    from lakelayer.operators.dq import Rule, report

    rules = [
        Rule.positive("l_quantity"),
        Rule.in_range("l_discount", 0, 0.1),
        Rule.in_range("l_tax", 0, 0.08),
        Rule.in_set("l_returnflag", ["A", "N", "R"]),
        Rule.not_null("l_shipdate"),
        Rule.unique_key("l_orderkey", "l_linenumber"),
    ]
    return report(S.load(spark, sf_dir, "lineitem"), rules)


def _lookup_sql() -> str:
    from lakelayer.plans.warehouse import CATEGORY_LABELS

    vals = ", ".join(f"('{k}', '{v}')" for k, v in sorted(CATEGORY_LABELS.items()))
    return f"(SELECT * FROM (VALUES {vals}) AS t(code, label))"


@query(
    "silver_translate",
    f"""
    SELECT p_partkey, p_type, COALESCE(lk.label, lower(p_type)) AS category
    FROM part LEFT JOIN {_lookup_sql()} lk ON p_type = lk.code
    """,
)
def silver_translate(spark, sf_dir):
    from lakelayer.operators.lookup import lookup_table, translate
    from lakelayer.plans.warehouse import CATEGORY_LABELS

    lk, n = lookup_table(spark, CATEGORY_LABELS)
    p = S.load(spark, sf_dir, "part")
    return translate(p, lk, "p_type", "category", lookup_rows=n).select("p_partkey", "p_type", "category")


SPEND_SQL = "(SELECT o_custkey, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey)"
SEGMENT_SQL = (
    "CASE WHEN spend IS NULL THEN 'none' WHEN spend >= 3000000 THEN 'high' "
    "WHEN spend >= 1500000 THEN 'mid' ELSE 'low' END"
)


@query(
    "customer_segment",
    f"SELECT c_custkey, {SEGMENT_SQL} AS segment FROM customer LEFT JOIN {SPEND_SQL} s ON c_custkey = s.o_custkey",
)
def customer_segment(spark, sf_dir):
    from lakelayer.plans.silver import spend_segment

    c = S.load(spark, sf_dir, "customer")
    return spend_segment(c, S.load(spark, sf_dir, "orders"), "c_custkey", "o_custkey", "o_totalprice").select(
        "c_custkey", "segment"
    )


@query("geo_median", "SELECT c_nationkey, median(c_acctbal) AS median_acctbal FROM customer GROUP BY c_nationkey")
def geo_median(spark, sf_dir):
    from lakelayer.plans.warehouse import geo_medians

    return geo_medians(spark, sf_dir)


# ------------------------------------------------------------------ rollups
PAYMENTS_SQL = """
    SELECT user_id, round(sum(value), 2) AS payment_value, count(*) AS n_payments,
           CAST(count(*) AS INTEGER) AS payment_installments,
           max(CASE WHEN rn = 1 THEN payment_type END) AS payment_type
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn
          FROM (SELECT *, ['credit_card', 'boleto', 'voucher', 'debit_card'][(CAST(props->>'$.k' AS INTEGER) % 4) + 1]
                          AS payment_type
                FROM events WHERE event_type = 'purchase'))
    GROUP BY user_id"""
REVIEWS_SQL = """
    SELECT user_id, review_score, n_reviews FROM (
        SELECT user_id, (CAST(props->>'$.k' AS INTEGER) % 5) + 1 AS review_score,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
               count(*) OVER (PARTITION BY user_id) AS n_reviews
        FROM events WHERE event_type = 'click') WHERE rn = 1"""


@query("payments_rollup", PAYMENTS_SQL)
def payments_rollup(spark, sf_dir):
    from lakelayer.plans.warehouse import payments

    return payments(spark, sf_dir)


@query("reviews_rollup", REVIEWS_SQL)
def reviews_rollup(spark, sf_dir):
    from lakelayer.plans.warehouse import reviews

    return reviews(spark, sf_dir)


# ------------------------------------------------------------------ gold
def sql_easter(year: str) -> str:
    """Easter Sunday of ``year`` (an integer column) by the Gregorian computus."""
    return f"""(SELECT make_date(yy, (h + l - 7 * m + 114) // 31, ((h + l - 7 * m + 114) % 31) + 1) FROM (
        SELECT yy, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM (
          SELECT yy, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
            SELECT yy, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM (
              SELECT yy, a, b, e, i, k, b // 4 AS d, (b - (b + 8) // 25 + 1) // 3 AS g FROM (
                SELECT {year} AS yy, {year} % 19 AS a, {year} // 100 AS b, ({year} // 100) % 4 AS e,
                       ({year} % 100) // 4 AS i, ({year} % 100) % 4 AS k))))))"""


def _dim_date_sql() -> str:
    return f"""
    WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders),
    days AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_id FROM span),
    yrs AS (SELECT y, {sql_easter('y')} AS easter FROM (SELECT DISTINCT CAST(year(date_id) AS INTEGER) AS y FROM days))
    SELECT {sql_surrogate_key(['date_id'], 'date')} AS date_sk, date_id,
           CAST(year(date_id) AS INTEGER) AS year, CAST(month(date_id) AS INTEGER) AS month,
           CAST(quarter(date_id) AS INTEGER) AS quarter, CAST(isodow(date_id) AS INTEGER) AS day_of_week,
           dayname(date_id) AS day_name, monthname(date_id) AS month_name,
           isodow(date_id) >= 6 AS is_weekend,
           (strftime(date_id, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02', '11-15', '12-25')
            OR (strftime(date_id, '%m-%d') = '11-20' AND year(date_id) >= 2024)
            OR date_id = easter - 2) AS is_holiday_br
    FROM days JOIN yrs ON CAST(year(date_id) AS INTEGER) = yrs.y"""


@query("dim_date", _dim_date_sql())
def dim_date_q(spark, sf_dir):
    from lakelayer.plans.gold import dim_date_for

    return dim_date_for(S.load(spark, sf_dir, "orders"), "o_orderdate")


WH_AS_OF = "2024-01-01"
WH_CTES = f"""
WITH items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
           CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value,
           l_shipdate AS delivered_ts, l_extendedprice / l_quantity AS unit_price
    FROM ({DEDUP_SQL})),
ord AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, o_orderdate AS purchase_ts,
           CAST(o_orderdate AS DATE) + {30} AS estimated_delivery_ts
    FROM orders),
customers AS (
    SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS state, c_nationkey AS zip_code,
           {SEGMENT_SQL} AS segment
    FROM customer LEFT JOIN {SPEND_SQL} s ON c_custkey = s.o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
dim_customer AS (
    SELECT {sql_surrogate_key(['customer_id', f"DATE '{WH_AS_OF}'"])} AS customer_sk, *,
           {sql_change_hash(['state', 'segment'])} AS _scd2_hash, DATE '{WH_AS_OF}' AS valid_from,
           DATE '9999-12-31' AS valid_to, TRUE AS is_current
    FROM customers),
latest AS (
    SELECT product_id, unit_price FROM (
        SELECT product_id, unit_price,
               row_number() OVER (PARTITION BY product_id ORDER BY delivered_ts DESC, order_id DESC, order_item_id DESC) AS rn
        FROM items) WHERE rn = 1),
products AS (
    SELECT p_partkey AS product_id, p_name AS name, COALESCE(lk.label, lower(p_type)) AS category, unit_price,
           CAST(round(unit_price * 100) AS BIGINT) AS unit_price_cents, p_size AS weight_g
    FROM part LEFT JOIN {_lookup_sql()} lk ON p_type = lk.code LEFT JOIN latest ON p_partkey = latest.product_id),
dim_product AS (
    SELECT {sql_surrogate_key(['product_id', f"DATE '{WH_AS_OF}'"])} AS product_sk, *,
           {sql_change_hash(['category', 'unit_price_cents', 'weight_g'])} AS _scd2_hash, DATE '{WH_AS_OF}' AS valid_from,
           DATE '9999-12-31' AS valid_to, TRUE AS is_current
    FROM products),
dim_seller AS (
    SELECT {sql_surrogate_key(['s_suppkey'], 'seller')} AS seller_sk, s_suppkey AS seller_id, s_name AS seller_name,
           n_name AS state, s_nationkey AS zip_code
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
lat AS (SELECT c_nationkey, median(c_acctbal) AS lat FROM customer GROUP BY c_nationkey),
lng AS (SELECT s_nationkey, median(s_acctbal) AS lng FROM supplier GROUP BY s_nationkey),
dim_geography AS (
    SELECT {sql_surrogate_key(['n_nationkey'], 'geo')} AS geo_sk, n_nationkey AS zip_code, n_name AS city,
           r_name AS state, lat, lng
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
         LEFT JOIN lat ON n_nationkey = lat.c_nationkey LEFT JOIN lng ON n_nationkey = lng.s_nationkey),
payments AS ({PAYMENTS_SQL}),
reviews AS ({REVIEWS_SQL}),
fact AS (
    SELECT {sql_surrogate_key(['i.order_id', 'i.order_item_id'], 'order_item')} AS order_sk,
           dc.customer_sk, dp.product_sk, ds.seller_sk,
           {sql_surrogate_key(['CAST(o.purchase_ts AS DATE)'], 'date')} AS date_sk, dg.geo_sk,
           i.order_id, i.order_item_id, i.quantity, i.price, i.freight_value,
           p.payment_value, p.payment_installments, p.payment_type, r.review_score, o.order_status,
           CAST(date_diff('day', CAST(o.purchase_ts AS DATE), CAST(i.delivered_ts AS DATE)) AS INTEGER) AS delivery_days,
           CAST(date_diff('day', CAST(o.estimated_delivery_ts AS DATE), CAST(i.delivered_ts AS DATE)) AS INTEGER) AS delay_days,
           strftime(o.purchase_ts, '%Y-%m') AS order_year_month
    FROM items i JOIN ord o ON i.order_id = o.order_id
         LEFT JOIN dim_customer dc ON dc.customer_id = o.customer_id
         LEFT JOIN dim_product dp ON dp.product_id = i.product_id
         LEFT JOIN dim_seller ds ON ds.seller_id = i.seller_id
         LEFT JOIN dim_geography dg ON dg.zip_code = dc.zip_code
         LEFT JOIN payments p ON p.user_id = o.customer_id
         LEFT JOIN reviews r ON r.user_id = o.customer_id)
"""


@query("dim_customer", WH_CTES + "SELECT * FROM dim_customer")
def dim_customer_q(spark, sf_dir):
    from lakelayer.plans import warehouse as W

    return W.dim_customer(spark, sf_dir)


@query("dim_product", WH_CTES + "SELECT * FROM dim_product")
def dim_product_q(spark, sf_dir):
    from lakelayer.plans import warehouse as W

    return W.dim_product(spark, sf_dir)


@query("dim_seller", WH_CTES + "SELECT * FROM dim_seller")
def dim_seller_q(spark, sf_dir):
    from lakelayer.plans import warehouse as W

    return W.dim_seller(spark, sf_dir)


@query("dim_geography", WH_CTES + "SELECT * FROM dim_geography")
def dim_geography_q(spark, sf_dir):
    from lakelayer.plans import warehouse as W

    return W.dim_geography(spark, sf_dir)


@query("fact_orders", WH_CTES + "SELECT * FROM fact")
def fact_orders_q(spark, sf_dir):
    from lakelayer.plans import warehouse as W

    return W.fact_orders(spark, sf_dir)


@query(
    "fact_delivery",
    WH_CTES
    + """SELECT order_year_month, count(*) AS n_items, CAST(sum(delivery_days) AS BIGINT) AS delivery_days,
       CAST(sum(delay_days) AS BIGINT) AS delay_days, count(*) FILTER (WHERE delay_days > 0) AS late_items
       FROM fact GROUP BY order_year_month""",
)
def fact_delivery(spark, sf_dir):
    from lakelayer.plans import warehouse as W

    f = W.order_items(spark, sf_dir)
    return f.groupBy("order_year_month").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("delivery_days").alias("delivery_days"),
        F.sum("delay_days").alias("delay_days"),
        F.count_if(F.col("delay_days") > 0).alias("late_items"),
    )


@query(
    "revenue_by_month",
    WH_CTES
    + """SELECT order_year_month, count(*) AS n_items, count(DISTINCT order_id) AS n_orders,
       round(sum(price), 2) AS revenue FROM fact GROUP BY order_year_month""",
)
def revenue_by_month(spark, sf_dir):
    from lakelayer.plans import gold as G
    from lakelayer.plans import warehouse as W

    return G.monthly_revenue(W.order_items(spark, sf_dir))


@query(
    "fact_pruned",
    WH_CTES + "SELECT * FROM fact WHERE order_year_month BETWEEN '1996-01' AND '1996-06'",
)
def fact_pruned(spark, sf_dir):
    """The fact written partitioned by month; a half-year read touches only
    those month directories (``PartitionFilters`` in the scan)."""
    from lakelayer.plans import warehouse as W

    f = W.stored_fact(spark, sf_dir).read()
    return f.filter(F.col("order_year_month").between("1996-01", "1996-06")).withColumn(
        "order_year_month", F.col("order_year_month").cast("string")
    )


@query(
    "fact_quarter_pruned",
    WH_CTES + "SELECT * FROM fact WHERE order_year_month IN ('1997-10', '1997-11', '1997-12')",
)
def fact_quarter_pruned(spark, sf_dir):
    """The months of a quarter come from the date dimension at run time; the scan of the
    fact is pruned dynamically."""
    from lakelayer.plans import gold as G
    from lakelayer.plans import warehouse as W

    quarter = G.dim_date(spark, "1992-01-01", "1999-12-31").filter("year = 1997 AND quarter = 4")
    return G.in_period(W.stored_fact(spark, sf_dir).read(), quarter)


# Registers the queries over several batches and snapshots.
from lakelayer.plans import catalog_batches as _batches  # noqa: E402,F401
