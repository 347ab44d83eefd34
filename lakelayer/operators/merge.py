"""Upserts and slowly changing dimensions as DataFrame rewrites.

Without a transactional table format there is no ``MERGE INTO``; each merge here is
a pure function ``(target, source) -> new table``. ``sinks.keyed.KeyedTable`` applies the
same rules to stored tables and rewrites only the buckets in which something changes.

SCD1: target rows whose key is absent from the source, plus every source row.
One shuffle of each side on the key (or a broadcast of the source when AQE sees
it is small).

SCD2: only *current* target rows take part in the key join; closed history
passes through untouched. The current rows and the enriched source meet in
one full outer join on the natural key, and each joined row emits up to two
output rows (the kept or closed old version, the new version) through one
``explode``: a single shuffle of the current rows and the source.

Natural keys are unique on each side of that join (validated on the source),
so no key can be hot; key columns may be composite.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.functions.hashing import change_hash
from lakelayer.functions.keys import surrogate_key

HASH_COL = "_scd2_hash"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"
OPEN_END = "9999-12-31"
SCD2_COLS = [HASH_COL, VALID_FROM, VALID_TO, IS_CURRENT]


class DuplicateKeyError(ValueError):
    pass


class OutOfOrderError(ValueError):
    pass


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def duplicate_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation before the shuffle)."""
    ks = _keys(keys)
    return df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique_keys(df: DataFrame, keys: str | list[str]) -> None:
    """Raise if a key repeats or is NULL (a NULL key never matches, so it would
    be inserted again on every run). One aggregation, at most one row returned."""
    ks = _keys(keys)
    bad = (
        df.groupBy(*ks)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | null_key_condition(ks))
        .limit(1)
        .collect()
    )
    if bad:
        raise DuplicateKeyError(f"source has duplicate or NULL keys on {ks}, e.g. {bad[0].asDict()}")


def assert_not_earlier(target: DataFrame, as_of: Column) -> None:
    """Raise if a current version starts after ``as_of`` (one column is read)."""
    late = target.filter(F.col(IS_CURRENT)).agg(F.max(VALID_FROM).alias("m")).filter(F.col("m") > as_of).collect()
    if late:
        raise OutOfOrderError(f"a current version starts on {late[0]['m']}, after the snapshot's date")


def null_key_condition(keys: str | list[str]) -> Column:
    cond = F.lit(False)
    for k in _keys(keys):
        cond = cond | F.col(k).isNull()
    return cond


# ---------------------------------------------------------------- SCD1
def merge_scd1(target: DataFrame, source: DataFrame, keys: str | list[str]) -> DataFrame:
    """Upsert: matched keys take the source row, new keys are inserted,
    target-only keys are kept. Columns follow the target's order. Duplicate and
    NULL source keys raise."""
    ks = _keys(keys)
    assert_unique_keys(source, ks)
    kept = target.join(source.select(*ks), on=ks, how="left_anti")
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return kept.unionByName(source.select(*cols))


# ---------------------------------------------------------------- SCD2
def scd2_enrich(
    source: DataFrame,
    keys: str | list[str],
    tracked: list[str],
    as_of=None,
    hash_mode: str = "safe",
    sk_col: str | None = None,
) -> DataFrame:
    """Add the change hash and an open validity interval starting ``as_of``;
    optionally a deterministic surrogate key (natural key + version start)."""
    ks = _keys(keys)
    d = _as_of(as_of)
    out = source.withColumns(
        {
            HASH_COL: change_hash(tracked, mode=hash_mode),
            VALID_FROM: d,
            VALID_TO: F.lit(OPEN_END).cast("date"),
            IS_CURRENT: F.lit(True),
        }
    )
    if sk_col:
        out = out.withColumn(sk_col, surrogate_key([*ks, VALID_FROM]))
        out = out.select(sk_col, *[c for c in out.columns if c != sk_col])
    return out


def scd2_initial(source: DataFrame, keys, tracked, as_of=None, hash_mode="safe", sk_col=None) -> DataFrame:
    """First load: every source row is the current version."""
    return scd2_enrich(source, keys, tracked, as_of, hash_mode, sk_col)


def _joined(target: DataFrame, enriched: DataFrame, keys: list[str]) -> DataFrame:
    current = target.filter(F.col(IS_CURRENT))
    t = current.select(F.struct(*[F.col(c) for c in current.columns]).alias("_t"), *keys)
    s = enriched.select(F.struct(*[F.col(c) for c in enriched.columns]).alias("_s"), *keys)
    return t.join(s, on=keys, how="full_outer")


def _flags(as_of: Column):
    t_here = F.col("_t").isNotNull()
    s_here = F.col("_s").isNotNull()
    changed = t_here & s_here & ~F.col(f"_t.{HASH_COL}").eqNullSafe(F.col(f"_s.{HASH_COL}"))
    same_day = changed & (F.col(f"_t.{VALID_FROM}") == as_of)
    return t_here, s_here, changed, same_day


def _closed_struct(cols: list[str], as_of: Column) -> Column:
    fields = []
    for c in cols:
        if c == VALID_TO:
            fields.append(F.date_sub(as_of, 1).alias(c))
        elif c == IS_CURRENT:
            fields.append(F.lit(False).alias(c))
        else:
            fields.append(F.col(f"_t.{c}").alias(c))
    return F.struct(*fields)


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: str | list[str],
    tracked: list[str],
    as_of=None,
    hash_mode: str = "safe",
    sk_col: str | None = None,
    validate: bool = True,
) -> DataFrame:
    """The whole next state of an SCD2 table.

    * unchanged key, or key gone from the source: current row kept as is;
    * changed key: current row closed with ``valid_to = as_of - 1`` and the new
      version inserted from ``as_of``; if the current row itself started on
      ``as_of`` (a second change the same day) it is replaced instead, so no
      interval ends before it starts;
    * new key: inserted.

    Duplicate or NULL source keys raise, and so does a snapshot older than a
    current version: history is only ever extended at its end.
    """
    ks = _keys(keys)
    d = _as_of(as_of)
    if validate:
        assert_unique_keys(source, ks)
        assert_not_earlier(target, d)
    enriched = scd2_enrich(source, ks, tracked, d, hash_mode, sk_col)
    cols = target.columns
    missing = [c for c in cols if c not in enriched.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    enriched = enriched.select(*cols)
    history = target.filter(~F.col(IS_CURRENT))
    j = _joined(target, enriched, ks)
    t_here, s_here, changed, same_day = _flags(d)
    keep_t = F.when(t_here & ~changed, F.col("_t"))
    close_t = F.when(changed & ~same_day, _closed_struct(cols, d))
    new_s = F.when(s_here & (~t_here | changed), F.col("_s"))
    old_row = F.coalesce(keep_t, close_t)
    rows = F.filter(F.array(old_row, new_s), lambda x: x.isNotNull())
    emitted = j.select(F.explode(rows).alias("_r")).select("_r.*")
    return history.unionByName(emitted)


def scd2_close(target: DataFrame, source: DataFrame, keys, tracked, as_of=None, hash_mode="safe", sk_col=None) -> DataFrame:
    """The target after the close step only: changed current rows closed
    (or dropped when replaced the same day), nothing inserted yet."""
    ks = _keys(keys)
    d = _as_of(as_of)
    enriched = scd2_enrich(source, ks, tracked, d, hash_mode, sk_col)
    cols = target.columns
    current = target.filter(F.col(IS_CURRENT))
    history = target.filter(~F.col(IS_CURRENT))
    s = enriched.select(*ks, F.col(HASH_COL).alias("_s_hash"))
    j = current.join(s, on=ks, how="left")
    changed = F.col("_s_hash").isNotNull() & ~F.col(HASH_COL).eqNullSafe(F.col("_s_hash"))
    same_day = changed & (F.col(VALID_FROM) == d)
    closed = j.filter(~same_day).select(
        *[
            F.when(changed, F.date_sub(d, 1)).otherwise(F.col(VALID_TO)).alias(c)
            if c == VALID_TO
            else F.when(changed, F.lit(False)).otherwise(F.col(IS_CURRENT)).alias(c)
            if c == IS_CURRENT
            else F.col(c)
            for c in cols
        ]
    )
    return history.unionByName(closed)


def scd2_current_keys(table: DataFrame, keys: str | list[str], extra: list[str] | None = None) -> DataFrame:
    return table.filter(F.col(IS_CURRENT)).select(*_keys(keys), *(extra or []))


def scd2_new_versions(target: DataFrame, source: DataFrame, keys, tracked, as_of=None, hash_mode="safe", sk_col=None) -> DataFrame:
    """Source rows to insert: keys with no current row once changed rows are
    closed, i.e. new keys and keys whose tracked values changed."""
    ks = _keys(keys)
    d = _as_of(as_of)
    enriched = scd2_enrich(source, ks, tracked, d, hash_mode, sk_col)
    unchanged_current = target.filter(F.col(IS_CURRENT)).select(*ks, F.col(HASH_COL).alias("_t_hash"))
    j = enriched.join(unchanged_current, on=ks, how="left")
    return j.filter(~F.col(HASH_COL).eqNullSafe(F.col("_t_hash"))).drop("_t_hash")
