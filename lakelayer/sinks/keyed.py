"""Tables laid out by the hash of their key, so that a merge rewrites changed buckets only.

Current rows lie in ``_state=current/_bucket=<n>``, closed versions of a key (SCD2) in
``_state=closed/_bucket=<n>``. A merge compares the incoming rows with the current ones
of the buckets that they fall in, finds the rows that change anything, and writes in one
commit: the touched buckets' current rows anew, and newly closed rows as additional
files. Buckets without a change keep their files, and closed history is never
rewritten, except where a snapshot arrives late (``merge_scd2`` then splices it into the
history of the keys that it changes).

Versions also store from when they hold in a join (``_effective_from``: the distant past
for a key's first version, else its start), so that no reader has to find first versions.

``seen`` (on request) keeps, per snapshot, the keys that it held: a small table
(key, date) that is only appended to. With it a late snapshot gives exactly the history
that the snapshots would have given in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelayer.operators import merge as M
from lakelayer.operators.dedup import dedup_latest
from lakelayer.session import checkpoint_root
from lakelayer.sinks.store import PathTable

STATE, BUCKET = "_state", "_bucket"
#: From when a version holds in an as-of join; a key's first version is open to the past.
EFFECTIVE = "_effective_from"
OPEN_PAST = "0001-01-01"
CURRENT, CLOSED = "current", "closed"
_SEEN_ON = "_seen_on"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, keys: str | list[str], n_buckets: int = 16, keep_seen: bool = False):
        """``n_buckets`` is fixed by the first write; later sessions read it from the table."""
        self.spark, self.keys = spark, M._keys(keys)
        self.table = PathTable(spark, f"{root.rstrip('/')}/rows", partition_by=[STATE, BUCKET])
        self.seen = PathTable(spark, f"{root.rstrip('/')}/seen") if keep_seen else None
        self.n_buckets = self.table.notes().get("n_buckets", n_buckets)

    # ---- reads ----------------------------------------------------------
    def exists(self) -> bool:
        return self.table.exists()

    def read(self) -> DataFrame:
        return self.table.read().drop(STATE, BUCKET, EFFECTIVE)

    def read_as_of(self) -> DataFrame:
        """All versions with ``_effective_from``."""
        return self.table.read().drop(STATE, BUCKET)

    def current_path(self) -> str | None:
        return self.table.current_path()

    def current(self) -> DataFrame:
        return self.table.read().filter(F.col(STATE) == CURRENT).drop(STATE, BUCKET, EFFECTIVE)

    def notes(self) -> dict:
        return self.table.notes()

    # ---- helpers --------------------------------------------------------
    def _placed(self, df: DataFrame, state=CURRENT) -> DataFrame:
        key = F.xxhash64(*[F.col(k).cast("string") for k in self.keys])
        placed = df.withColumn(STATE, F.lit(state) if isinstance(state, str) else state)
        return placed.withColumn(BUCKET, F.pmod(key, F.lit(self.n_buckets)).cast("int"))

    def _buckets(self, rows: DataFrame) -> list[int]:
        """Touched buckets: at most ``n_buckets`` numbers."""
        return [r[0] for r in rows.select(BUCKET).distinct().collect()]

    def _columns(self, source: DataFrame) -> list[str]:
        cols = [c for c in self.table.read().columns if c not in (STATE, BUCKET)]
        missing = [c for c in cols if c not in source.columns]
        if missing:
            raise ValueError(f"source lacks target columns {missing}")
        return cols

    def _cast(self, source: DataFrame, cols: list[str]) -> DataFrame:
        types = self.table.read().schema
        return source.select(*[F.col(c).cast(types[c].dataType).alias(c) for c in cols])

    def _commit(self, rows: DataFrame, touched: list[int], notes: dict | None = None, history: bool = False) -> int:
        """Replace the current rows of the ``touched`` buckets (and with ``history`` the closed
        ones); other closed rows are added."""
        states = (CURRENT, CLOSED) if history else (CURRENT,)
        old = {f"{STATE}={state}/{BUCKET}={b}" for state in states for b in touched}
        return self.table.commit(rows, lambda leaf, new: leaf in old, notes={"n_buckets": self.n_buckets, **(notes or {})})

    def _checkpoint(self, df: DataFrame) -> DataFrame:
        checkpoint_root(self.spark)
        return df.checkpoint()

    # ---- writes ---------------------------------------------------------
    def load(self, df: DataFrame, notes: dict | None = None) -> int:
        """First write: every row is current."""
        rows = self._placed(df)
        return self.table.overwrite(rows, notes={"n_buckets": self.n_buckets, **(notes or {})})

    def merge_scd1(self, source: DataFrame, notes: dict | None = None) -> list[int]:
        """Upsert; keys absent from the source stay. Returns the rewritten buckets. Rows
        equal to the stored ones change nothing."""
        M.assert_unique_keys(source, self.keys)
        cols = self._columns(source)
        incoming = self._placed(self._cast(source, cols))
        stored = self.table.read()
        old = stored.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.struct(*cols).alias("_old"), F.col(BUCKET).alias("_b"))
        same_key = [incoming[k] == old[f"_k_{k}"] for k in self.keys]
        matched = incoming.join(old, [incoming[BUCKET] == old["_b"], *same_key], "left")
        changed = self._checkpoint(matched.filter(~F.struct(*cols).eqNullSafe(F.col("_old"))).select(*cols, STATE, BUCKET))
        touched = self._buckets(changed)
        if touched:
            kept = stored.filter(F.col(BUCKET).isin(touched)).join(changed.select(*self.keys), self.keys, "left_anti")
            self._commit(kept.select(*cols, STATE, BUCKET).unionByName(changed), touched, notes)
        return touched

    def merge_latest(self, rows: DataFrame, order_by: list, notes: dict | None = None, gone: DataFrame | None = None, staged: bool = False) -> list[int]:
        """Upsert in which a stored row yields only to a row of its key that is later in
        ``order_by``. Stored rows of the keys ``gone`` are taken out first. ``staged``: the
        rows are materialised, one per key, and are not written aside again. Returns the
        rewritten buckets."""
        cols = self._columns(rows)
        incoming = self._placed(self._cast(rows, cols))
        if not staged:
            incoming = self._checkpoint(self._placed(dedup_latest(self._cast(rows, cols), self.keys, order_by)))
        touched = self._buckets(incoming)
        if gone is not None:
            gone = self._checkpoint(self._placed(gone.select(*self.keys).distinct()))
            touched = sorted({*touched, *self._buckets(gone)})
        if touched:
            stored = self.table.read().filter(F.col(BUCKET).isin(touched))
            if gone is not None:
                same = [stored[k].eqNullSafe(gone[k]) for k in self.keys]
                stored = stored.join(gone, [stored[BUCKET] == gone[BUCKET], *same], "left_anti")
            merged = dedup_latest(stored.unionByName(incoming), self.keys, order_by)
            self._commit(merged.select(*cols, STATE, BUCKET), touched, notes)
        elif notes:
            self.table.commit(None, lambda leaf, new: False, notes=notes)
        return touched

    def load_scd2(self, source: DataFrame, tracked: list[str], as_of, sk_col: str | None = None, hash_mode: str = "safe") -> int:
        M.assert_unique_keys(source, self.keys)
        rows = M.scd2_initial(source, self.keys, tracked, as_of, hash_mode, sk_col)
        number = self.load(rows.withColumn(EFFECTIVE, F.lit(OPEN_PAST).cast("date")))
        self._note_seen(source, as_of)
        return number

    def merge_scd2(self, source: DataFrame, tracked: list[str], as_of, sk_col: str | None = None, hash_mode: str = "safe") -> list[int]:
        """The next state after a snapshot, as ``operators.merge.scd2_merge`` defines it.
        Returns the rewritten buckets. A snapshot older than a current version goes into
        the history (needs ``keep_seen``)."""
        M.assert_unique_keys(source, self.keys)
        day = M._as_of(as_of)
        current = self.table.read().filter(F.col(STATE) == CURRENT)
        if not current.filter(F.col(M.VALID_FROM) > day).isEmpty() or (self.seen and self._seen_after(day)):
            touched = self._splice(source, tracked, as_of, sk_col, hash_mode)
        else:
            touched = self._extend(source, tracked, day, sk_col, hash_mode)
        self._note_seen(source, as_of)
        return touched

    def _extend(self, source, tracked, day, sk_col, hash_mode) -> list[int]:
        enriched = M.scd2_enrich(source, self.keys, tracked, day, hash_mode, sk_col).withColumn(EFFECTIVE, day)
        cols = self._columns(enriched)
        incoming = self._placed(self._cast(enriched, cols))
        stored = self.table.read().filter(F.col(STATE) == CURRENT)
        old = stored.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.struct(*cols).alias("_old"), F.col(BUCKET).alias("_b"))
        matched = incoming.join(old, [incoming[BUCKET] == old["_b"], *[incoming[k] == old[f"_k_{k}"] for k in self.keys]], "left")
        differs = F.col("_old").isNull() | ~F.col(M.HASH_COL).eqNullSafe(F.col(f"_old.{M.HASH_COL}"))
        replaced = F.col("_old").isNull() | (F.col(f"_old.{M.VALID_FROM}") == day)
        inherited = F.coalesce(F.col(f"_old.{EFFECTIVE}"), F.lit(OPEN_PAST).cast("date"))
        matched = matched.withColumn(EFFECTIVE, F.when(replaced, inherited).otherwise(F.col(EFFECTIVE)))
        changed = self._checkpoint(matched.filter(differs).select(*cols, STATE, BUCKET, "_old"))
        touched = self._buckets(changed)
        if not touched:
            return touched
        kept = stored.filter(F.col(BUCKET).isin(touched)).join(changed.select(*self.keys), self.keys, "left_anti")
        # A version that started on the same day is replaced, not closed.
        ended = changed.filter(F.col(f"_old.{M.VALID_FROM}") < day).select("_old.*", BUCKET)
        ended = ended.withColumns({M.VALID_TO: F.date_sub(day, 1), M.IS_CURRENT: F.lit(False), STATE: F.lit(CLOSED)})
        out = [*cols, STATE, BUCKET]
        self._commit(kept.select(*out).unionByName(changed.select(*out)).unionByName(ended.select(*out)), touched)
        return touched

    # ---- late snapshots -------------------------------------------------
    def _seen_after(self, day) -> bool:
        return self.seen.exists() and not self.seen.read().filter(F.col(_SEEN_ON) > day).isEmpty()

    def _note_seen(self, source: DataFrame, as_of) -> None:
        if self.seen is not None:
            self.seen.append(source.select(*self.keys, M._as_of(as_of).alias(_SEEN_ON)).distinct())

    def _splice(self, source, tracked, as_of, sk_col, hash_mode) -> list[int]:
        """A key's history is rebuilt from its events in order of date: the starts of its
        versions, the later snapshots that confirmed a version, and the late row. An event
        that repeats the hash before it is no version of its own."""
        if self.seen is None or not self.seen.exists():
            raise M.OutOfOrderError("a late snapshot needs the table of seen keys (keep_seen)")
        from lakelayer.functions.keys import surrogate_key

        day = M._as_of(as_of)
        enriched = M.scd2_enrich(source, self.keys, tracked, day, hash_mode, sk_col).withColumn(EFFECTIVE, day)
        cols = self._columns(enriched)
        late = self._placed(self._cast(enriched, cols))
        stored = self.table.read()
        valid = stored.filter((F.col(M.VALID_FROM) <= day) & (F.col(M.VALID_TO) >= day))
        same = late.join(valid.select(*self.keys, M.HASH_COL), [*self.keys, M.HASH_COL], "left_anti")
        changed = self._checkpoint(same.select(*cols, STATE, BUCKET))
        touched = self._buckets(changed)
        if not touched:
            return touched
        keys = changed.select(*self.keys)
        versions = stored.filter(F.col(BUCKET).isin(touched))
        old = versions.join(keys, self.keys, "left_semi")
        event = [*cols, BUCKET, "_on", "_rank"]
        starts = old.select(*cols, BUCKET, F.col(M.VALID_FROM).alias("_on"), F.lit(0).alias("_rank"))
        seen = self.seen.read().join(keys, self.keys, "left_semi").filter(F.col(_SEEN_ON) != day).distinct()
        confirmed = old.join(seen, self.keys).filter((F.col(_SEEN_ON) > F.col(M.VALID_FROM)) & (F.col(_SEEN_ON) <= F.col(M.VALID_TO)))
        confirmed = confirmed.select(*cols, BUCKET, F.col(_SEEN_ON).alias("_on"), F.lit(0).alias("_rank"))
        new = changed.select(*cols, BUCKET, day.alias("_on"), F.lit(1).alias("_rank"))
        events = starts.unionByName(confirmed).unionByName(new).select(*event)
        # Of one date the late row counts. A key has few events: its versions and snapshots.
        last = Window.partitionBy(*self.keys, "_on").orderBy(F.desc("_rank"))
        order = Window.partitionBy(*self.keys).orderBy("_on")
        events = events.withColumn("_n", F.row_number().over(last)).filter("_n = 1")
        events = events.withColumn("_before", F.lag(M.HASH_COL).over(order)).withColumn("_nth", F.row_number().over(order))
        events = events.filter((F.col("_nth") == 1) | ~F.col("_before").eqNullSafe(F.col(M.HASH_COL)))
        events = events.withColumn("_next", F.lead("_on").over(order))
        rebuilt = events.withColumns(
            {
                M.VALID_FROM: F.col("_on"),
                EFFECTIVE: F.when(F.col("_nth") == 1, F.lit(OPEN_PAST).cast("date")).otherwise(F.col("_on")),
                M.VALID_TO: F.coalesce(F.date_sub("_next", 1), F.lit(M.OPEN_END).cast("date")),
                M.IS_CURRENT: F.col("_next").isNull(),
                STATE: F.when(F.col("_next").isNull(), F.lit(CURRENT)).otherwise(F.lit(CLOSED)),
            }
        )
        if sk_col:
            rebuilt = rebuilt.withColumn(sk_col, surrogate_key([*self.keys, M.VALID_FROM]))
        out = [*cols, STATE, BUCKET]
        others = versions.join(keys, self.keys, "left_anti").select(*out)
        self._commit(others.unionByName(rebuilt.select(*out)), touched, history=True)
        return touched
