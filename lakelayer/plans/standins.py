"""Raw exports derived from the driver's tables, with faults injected by rule.

The driver's tables are clean typed Parquet. Ingestion operators need dirty
text, so each stand-in turns one table into CSV lines (Spark, distributed) with
faults decided by the row's integer key:

* ``key % 17 = 0``  first (required) field empty           -> missing_required_field
* ``key % 23 = 0``  one extra field at the end of the line   -> malformed_record
* ``key % 29 = 0``  a numeric field written as text           -> bad_type
* ``key % 31 = 0``  a timestamp field without its time part  -> bad_type

Because the rules are arithmetic on the key, the expected typed rows and
reasons can be stated independently in SQL over the same table (``oracle_*``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.contracts import Contract, get_contract

# The fault rules (modulus of the row key per fault kind).
NULL_KEY_MOD = 17
RAGGED_MOD = 23
BAD_NUMBER_MOD = 29
BAD_TS_MOD = 31
BAD_NUMBER_TEXT = "n/a"
RAGGED_TAIL = "EXTRA"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class StandIn:
    table: str
    contract: str
    key: str  # integer column of the source table driving the rules
    columns: tuple[str, ...]  # source column per contract field, in order
    bad_number: str | None  # contract field written as text when key % 29 = 0
    bad_ts: str | None  # contract field written date-only when key % 31 = 0

    def spec(self) -> Contract:
        return get_contract(self.contract)


STANDINS = {
    "orders": StandIn(
        "orders", "orders_raw", "o_orderkey",
        ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
        "total_price", "purchase_ts",
    ),
    "customer": StandIn(
        "customer", "customer_raw", "c_custkey",
        ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
        "nation_key", None,
    ),
    "part": StandIn(
        "part", "part_raw", "p_partkey",
        ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        "retail_price", None,
    ),
    "supplier": StandIn(
        "supplier", "supplier_raw", "s_suppkey",
        ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
        "acctbal", None,
    ),
    "lineitem": StandIn(
        "lineitem", "lineitem_raw", "l_orderkey",
        ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
        "price", "ship_ts",
    ),
}


def table_path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


# ------------------------------------------------------------------ Spark side
def _csv_field(text):
    """Quote a cell when it holds a separator, a quote or a line break."""
    needs = text.contains(",") | text.contains('"') | text.contains("\n") | text.contains("\r")
    quoted = F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))
    return F.when(needs, quoted).otherwise(text)


def _text_of(col: str, type_name: str):
    c = F.col(col)
    if type_name in ("timestamp", "timestamp_ntz"):
        return F.date_format(c, TS_FORMAT)
    return c.cast("string")


def raw_cells(df: DataFrame, s: StandIn, faults: bool = True) -> dict:
    """Contract field -> raw text column, with the faults unless ``faults`` is off (no ragged lines)."""
    k = F.col(s.key)
    c = s.spec()
    cells = {}
    for i, (f, src) in enumerate(zip(c.fields, s.columns)):
        text = _text_of(src, f.type)
        cells[f.name] = text
        if not faults:
            continue
        if i == 0:
            text = F.when(k % NULL_KEY_MOD == 0, F.lit(None).cast("string")).otherwise(text)
        if f.name == s.bad_number:
            text = F.when(k % BAD_NUMBER_MOD == 0, F.lit(BAD_NUMBER_TEXT)).otherwise(text)
        if f.name == s.bad_ts:
            text = F.when(k % BAD_TS_MOD == 0, F.date_format(F.col(src), "yyyy-MM-dd")).otherwise(text)
        cells[f.name] = text
    return cells


def raw_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """String-typed frame with contract field names (faults but no ragged lines)."""
    s = STANDINS[name]
    df = load(spark, sf_dir, s.table)
    return df.select(*[v.alias(n) for n, v in raw_cells(df, s).items()])


def raw_lines(spark: SparkSession, sf_dir: str, name: str, faults: bool = True) -> DataFrame:
    s = STANDINS[name]
    df = load(spark, sf_dir, s.table)
    types = {f.name: f.type for f in s.spec().fields}
    # only text cells can hold a separator or a quote; numbers and dates never do
    cells = [
        F.coalesce(_csv_field(v) if types[n] == "string" else v, F.lit(""))
        for n, v in raw_cells(df, s, faults).items()
    ]
    line = F.concat_ws(",", *cells)
    if not faults:
        return df.select(line.alias("value"))
    line = F.when(F.col(s.key) % RAGGED_MOD == 0, F.concat(line, F.lit("," + RAGGED_TAIL))).otherwise(line)
    return df.select(line.alias("value"))


def write_raw_csv(spark: SparkSession, sf_dir: str, name: str, path: str, faults: bool = True) -> str:
    """Materialise the export (dirty, unless ``faults`` is off) as headerless CSV text files under ``path``."""
    raw_lines(spark, sf_dir, name, faults).write.mode("overwrite").text(path)
    return path


# ------------------------------------------------------------------ SQL side
def oracle_typed_select(name: str, include_reason: bool = True, ragged: bool = True) -> str:
    """SELECT list (over the source table) of the expected typed fields and reason."""
    s = STANDINS[name]
    c = s.spec()
    k = s.key
    cols = []
    for i, (f, src) in enumerate(zip(c.fields, s.columns)):
        if f.type == "string":
            v = f"CAST({src} AS VARCHAR)"
        elif f.type == "integer":
            v = f"CAST({src} AS INTEGER)"
        elif f.type == "long":
            v = f"CAST({src} AS BIGINT)"
        elif f.type == "double":
            v = f"CAST({src} AS DOUBLE)"
        else:
            v = src
        nulls = []
        if i == 0:
            nulls.append(f"{k} % {NULL_KEY_MOD} = 0")
        if f.name == s.bad_number:
            nulls.append(f"{k} % {BAD_NUMBER_MOD} = 0")
        if f.name == s.bad_ts:
            nulls.append(f"{k} % {BAD_TS_MOD} = 0")
        if nulls:
            v = f"CASE WHEN {' OR '.join(nulls)} THEN NULL ELSE {v} END"
        cols.append(f"{v} AS {f.name}")
    if include_reason:
        cols.append(f"{oracle_reason(name, ragged)} AS _quarantine_reason")
    return ", ".join(cols)


def oracle_reason(name: str, ragged: bool = True) -> str:
    s = STANDINS[name]
    c = s.spec()
    k = s.key
    src = dict(zip(c.names, s.columns))
    branches = []
    if ragged:
        branches.append((f"{k} % {RAGGED_MOD} = 0", "malformed_record"))
    for f in c.fields:  # bad types in contract order
        if f.name == s.bad_number:
            branches.append((f"{k} % {BAD_NUMBER_MOD} = 0", f"bad_type:{f.name}"))
        if f.name == s.bad_ts:
            branches.append((f"{k} % {BAD_TS_MOD} = 0", f"bad_type:{f.name}"))
    for i, f in enumerate(c.fields):  # missing required, contract order
        if not f.required:
            continue
        conds = [f"{src[f.name]} IS NULL"]
        if i == 0:
            conds.append(f"{k} % {NULL_KEY_MOD} = 0")
        branches.append((" OR ".join(conds), f"missing_required_field:{f.name}"))
    return "CASE " + " ".join(f"WHEN {c_} THEN '{r}'" for c_, r in branches) + " END"
