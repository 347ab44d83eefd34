"""SCD1 and SCD2 rewrites: outcomes and invariants."""

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import merge as M
from lakelayer.sinks.store import PathTable

D1, D2, D3 = "2024-01-01", "2024-02-01", "2024-03-01"


def test_scd1_upsert_and_idempotence(spark, tmp):
    t = PathTable(spark, f"{tmp}/scd1")
    t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    src = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    t.overwrite(M.merge_scd1(t.read(), src, "k"))
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "B"), (3, "C")]
    t.overwrite(M.merge_scd1(t.read(), src, "k"))
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_scd1_composite_key(spark):
    tgt = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k1 int, k2 int, v string")
    src = spark.createDataFrame([(1, 2, "B")], "k1 int, k2 int, v string")
    got = sorted(tuple(r) for r in M.merge_scd1(tgt, src, ["k1", "k2"]).collect())
    assert got == [(1, 1, "a"), (1, 2, "B")]


def _snap(spark, rows):
    return spark.createDataFrame(rows, "k int, city string, seg string, extra int")


def _check_invariants(df):
    rows = df.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append(r)
    for k, versions in by_key.items():
        assert sum(v.is_current for v in versions) <= 1, k
        vs = sorted(versions, key=lambda v: v.valid_from)
        for a in vs:
            assert a.valid_from <= a.valid_to, (k, a)
        for a, b in zip(vs, vs[1:]):
            assert a.valid_to < b.valid_from, (k, a, b)
    return by_key


def test_scd2_history(spark):
    s1 = _snap(spark, [(1, "x", "A", 0), (2, "y", "B", 0), (3, "z", "C", 0)])
    t = M.scd2_initial(s1, "k", ["city", "seg"], D1, sk_col="sk")
    s2 = _snap(spark, [(1, "x", "A", 5), (2, "y2", "B", 0), (4, "w", "D", 0)])  # 1 untracked change, 2 changed, 3 gone, 4 new
    t2 = M.scd2_merge(t, s2, "k", ["city", "seg"], D2, sk_col="sk", validate=True)
    by_key = _check_invariants(t2)
    assert len(by_key[1]) == 1 and by_key[1][0].extra == 0  # untracked change ignored
    old, new = sorted(by_key[2], key=lambda r: r.valid_from)
    assert (old.is_current, str(old.valid_to)) == (False, "2024-01-31")
    assert (new.is_current, new.city, str(new.valid_from)) == (True, "y2", D2)
    assert old.sk != new.sk
    assert by_key[3][0].is_current  # keys gone from the source stay current
    assert by_key[4][0].is_current and str(by_key[4][0].valid_from) == D2
    # the same snapshot again changes nothing
    t3 = M.scd2_merge(t2, s2, "k", ["city", "seg"], D3, sk_col="sk")
    assert sorted(map(tuple, t3.collect())) == sorted(map(tuple, t2.collect()))


def test_scd2_two_changes_same_day_replace(spark):
    t = M.scd2_initial(_snap(spark, [(1, "x", "A", 0)]), "k", ["city", "seg"], D1)
    t = M.scd2_merge(t, _snap(spark, [(1, "x2", "A", 0)]), "k", ["city", "seg"], D2)
    t = M.scd2_merge(t, _snap(spark, [(1, "x3", "A", 0)]), "k", ["city", "seg"], D2)
    by_key = _check_invariants(t)
    assert sorted((r.city, r.is_current) for r in by_key[1]) == [("x", False), ("x3", True)]


def test_safe_hash_sees_null_moving_between_columns(spark):
    t = M.scd2_initial(_snap(spark, [(1, None, "a", 0)]), "k", ["city", "seg"], D1)
    moved = _snap(spark, [(1, "a", None, 0)])
    safe = M.scd2_merge(t, moved, "k", ["city", "seg"], D2)
    assert safe.count() == 2
    t_c = M.scd2_initial(_snap(spark, [(1, None, "a", 0)]), "k", ["city", "seg"], D1, hash_mode="concat")
    plain = M.scd2_merge(t_c, moved, "k", ["city", "seg"], D2, hash_mode="concat")
    assert plain.count() == 1  # the plain concat hash misses it


def test_duplicate_source_keys_raise(spark):
    t = M.scd2_initial(_snap(spark, [(1, "x", "A", 0)]), "k", ["city"], D1)
    dup = _snap(spark, [(1, "x", "A", 0), (1, "y", "A", 0)])
    with pytest.raises(M.DuplicateKeyError):
        M.scd2_merge(t, dup, "k", ["city"], D2, validate=True)


def test_scd2_steps_compose_to_merge(spark):
    s1 = _snap(spark, [(1, "x", "A", 0), (2, "y", "B", 0)])
    t = M.scd2_initial(s1, "k", ["city"], D1)
    s2 = _snap(spark, [(1, "x", "A", 0), (2, "y2", "B", 0), (3, "z", "C", 0)])
    closed = M.scd2_close(t, s2, "k", ["city"], D2)
    new = M.scd2_new_versions(t, s2, "k", ["city"], D2)
    assert sorted(r.k for r in new.collect()) == [2, 3]
    both = closed.unionByName(new)
    merged = M.scd2_merge(t, s2, "k", ["city"], D2)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, merged.select(*both.columns).collect()))
    assert sorted(r.k for r in M.scd2_current_keys(merged, "k").collect()) == [1, 2, 3]


def test_scd2_merge_plan_has_one_join(spark):
    t = M.scd2_initial(_snap(spark, [(1, "x", "A", 0)]), "k", ["city"], D1)
    plan = M.scd2_merge(t, _snap(spark, [(1, "y", "A", 0)]), "k", ["city"], D2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 or "BroadcastHashJoin" in plan or "SortMergeJoin" in plan


def test_null_source_key_raises(spark):
    t = M.scd2_initial(_snap(spark, [(1, "x", "A", 0)]), "k", ["city"], D1)
    with pytest.raises(M.DuplicateKeyError, match="NULL"):
        M.scd2_merge(t, _snap(spark, [(None, "x", "A", 0)]), "k", ["city"], D2, validate=True)
