"""Keyed tables: merges rewrite changed buckets only; late snapshots; failed writes."""

import itertools

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import merge as M
from lakelayer.sinks.keyed import KeyedTable
from lakelayer.sinks.store import ConcurrentCommitError, PathTable

D1, D2, D3 = "2024-01-01", "2024-02-01", "2024-03-01"


def files(t: PathTable) -> dict:
    return {leaf: t.folders(leaf) for leaf in t.partitions()}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def customers(spark, n=400):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("city"), F.col("id") % 7).alias("city"), F.lit(0).alias("extra"))


def test_scd1_merge_rewrites_touched_buckets(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "k", n_buckets=32)
    base = customers(spark)
    t.load(base)
    before = files(t.table)
    delta = base.filter("k IN (3, 77, 200, 399)").withColumn("city", F.lit("moved")).union(spark.createDataFrame([(1000, "new", 1)], "k long, city string, extra int"))
    touched = t.merge_scd1(delta)
    after = files(t.table)
    rewritten = {leaf for leaf in after if after[leaf] != before.get(leaf)}
    assert 0 < len(touched) <= 5 and rewritten == {f"_state=current/_bucket={b}" for b in touched}
    assert rows(t.read()) == rows(M.merge_scd1(base, delta, "k"))
    # The same rows again, and the whole snapshot, change no file.
    assert t.merge_scd1(delta) == [] and t.merge_scd1(t.read()) == [] and files(t.table) == after


def test_scd2_merge_appends_closed_history(spark, tmp):
    base = customers(spark)
    t = KeyedTable(spark, f"{tmp}/t", "k", n_buckets=32)
    t.load_scd2(base, ["city"], D1, sk_col="sk")
    plain = M.scd2_initial(base, "k", ["city"], D1, sk_col="sk")
    history = None
    for day, k, city in ((D2, "k % 100 = 5", "two"), (D3, "k % 100 = 5 AND k < 200", "three"), (D3, "k = 5", "three again")):
        snapshot = base.withColumn("city", F.when(F.expr(k), F.lit(city)).otherwise(F.col("city")))
        delta = snapshot.filter(F.expr(k)).withColumn("extra", F.lit(9))
        before = files(t.table)
        touched = t.merge_scd2(delta, ["city"], day, sk_col="sk")
        plain = M.scd2_merge(plain, delta, "k", ["city"], day, sk_col="sk")
        assert rows(t.read().select(*plain.columns)) == rows(plain)
        after = files(t.table)
        assert {x for x in after if x.startswith("_state=current") and after[x] != before.get(x)} == {f"_state=current/_bucket={b}" for b in touched}
        # What is closed stays in its files; new closed rows lie beside it.
        assert all(set(before[x]) <= set(after[x]) for x in before if x.startswith("_state=closed"))
        history = after
    assert any(len(v) > 1 for x, v in history.items() if x.startswith("_state=closed"))


SNAPSHOTS = {
    D1: [(1, "a"), (2, "x"), (3, "p"), (5, "m")],
    D2: [(1, "b"), (2, "y"), (3, "p"), (4, "n"), (6, "s")],
    D3: [(1, "b"), (2, "x"), (4, "n2"), (5, "m"), (6, "s")],
}


@pytest.mark.parametrize("order", list(itertools.permutations(SNAPSHOTS)))
def test_snapshots_in_any_order_give_one_history(spark, tmp, order):
    def build(name, days):
        t = KeyedTable(spark, f"{tmp}/{name}", "k", n_buckets=4, keep_seen=True)
        for i, day in enumerate(days):
            snap = spark.createDataFrame(SNAPSHOTS[day], "k int, city string")
            t.load_scd2(snap, ["city"], day, sk_col="sk") if i == 0 else t.merge_scd2(snap, ["city"], day, sk_col="sk")
        return rows(t.read().select("k", "city", "valid_from", "valid_to", "is_current", "sk"))

    assert build("any", order) == build("ordered", sorted(SNAPSHOTS))


def test_late_snapshot_without_seen_keys_raises(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "k")
    t.load_scd2(spark.createDataFrame([(1, "a")], "k int, city string"), ["city"], D2)
    with pytest.raises(M.OutOfOrderError):
        t.merge_scd2(spark.createDataFrame([(1, "b")], "k int, city string"), ["city"], D1)


def failing(df):
    return df.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("task fails")).cast("int")).otherwise(F.col("v")))


def test_failed_rerun_leaves_the_batch_readable(spark, tmp):
    t = PathTable(spark, f"{tmp}/bronze", partition_by=["_batch_id", "s"], rebalance=False)
    batch = spark.createDataFrame([(i, i % 2, i) for i in range(5)], "id int, s int, v int").repartition(5)
    t.append(batch, batch_id="001")
    t.append(batch.filter("id < 2"), batch_id="002")
    before, folders = rows(t.read()), files(t)
    for write in (lambda df: t.append(df, batch_id="001"), t.overwrite, t.overwrite_partitions):
        with pytest.raises(Exception, match="task fails"):
            write(failing(batch).withColumn("_batch_id", F.lit("001")))
        assert rows(t.read()) == before and files(t) == folders
    # The next commit removes what the failed attempts left.
    t.append(batch.filter("id = 4"), batch_id="001")
    assert [r for r in rows(t.read()) if r[-2] == "001"] == [(4, 4, "001", 0)]
    named = {c for v in t.versions() for c, _ in t._manifest(v)["live"]}
    assert {n.partition("=")[2] for n in t._names(f"{t.root}/data")} == named


def test_old_versions_are_removed(spark, tmp):
    t = PathTable(spark, f"{tmp}/t", keep_versions=2)
    for i in range(5):
        t.overwrite(spark.createDataFrame([(i,)], "id int"))
    assert t.versions() == [4, 5] and len(t._names(f"{t.root}/data")) == 2
    assert t.read(4).first()[0] == 3 and t.read().first()[0] == 4


def test_second_writer_of_a_version_fails(spark, tmp):
    t = PathTable(spark, f"{tmp}/t")
    t.overwrite(spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(ConcurrentCommitError):
        t._publish({**t._manifest(), "notes": {"by": "another"}})
    assert t.notes() == {}


def test_replace_where(spark, tmp):
    t = PathTable(spark, f"{tmp}/t", partition_by=["month"])
    data = [(1, "2024-01"), (2, "2024-02"), (3, "2024-03"), (4, None)]
    t.overwrite(spark.createDataFrame(data, "id int, month string"))
    kept = t.folders("month=2024-03")
    t.replace_where(spark.createDataFrame([(9, "2024-01")], "id int, month string"), "month <= '2024-02'")
    # February vanishes, January is new, March and the NULL month are untouched.
    assert rows(t.read()) == [(3, "2024-03"), (4, None), (9, "2024-01")] and t.folders("month=2024-03") == kept
    with pytest.raises(ValueError):
        t.replace_where(spark.createDataFrame([(9, "2024-03")], "id int, month string"), "month <= '2024-02'")
    t.replace_where(None, F.col("month").isNull())
    assert rows(t.read()) == [(3, "2024-03"), (9, "2024-01")]
    t.replace_where(None, "month > '2000'")
    assert t.read().count() == 0 and t.read().columns == ["id", "month"]
    t.append(spark.createDataFrame([(5, "2024-05")], "id int, month string"))
    assert rows(t.read()) == [(5, "2024-05")]
