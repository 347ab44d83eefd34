"""Path tables: partition overwrite, idempotent append, versioned overwrite."""

from pyspark.sql import functions as F

from lakelayer.sinks.store import PathTable


def _months(spark, rows):
    return spark.createDataFrame(rows, "id int, month string, v int")


def test_partition_overwrite_keeps_other_months(spark, tmp):
    t = PathTable(spark, f"{tmp}/fact", partition_by=["month"])
    t.overwrite(_months(spark, [(1, "2024-01", 1), (2, "2024-02", 1), (3, "2024-03", 1)]))
    t.overwrite_partitions(_months(spark, [(20, "2024-02", 2), (21, "2024-02", 2)]))
    got = sorted((r.id, r.month, r.v) for r in t.read().collect())
    assert got == [(1, "2024-01", 1), (3, "2024-03", 1), (20, "2024-02", 2), (21, "2024-02", 2)]
    # an empty frame is a no-op
    t.overwrite_partitions(_months(spark, []))
    assert t.read().count() == 4
    # a NULL month is its own partition and leaves the others alone
    t.overwrite_partitions(_months(spark, [(9, None, 3)]))
    assert t.read().count() == 5 and t.read().filter(F.col("month").isNull()).count() == 1


def test_batch_append_is_idempotent(spark, tmp):
    t = PathTable(spark, f"{tmp}/bronze")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    t.append(df, batch_id="b1")
    t.append(df, batch_id="b1")
    t.append(df, batch_id="b2")
    got = sorted((r.id, r._batch_id) for r in t.read().collect())
    assert got == [(1, "b1"), (1, "b2"), (2, "b1"), (2, "b2")]


def test_overwrite_is_a_new_version(spark, tmp):
    t = PathTable(spark, f"{tmp}/t")
    assert not t.exists()
    t.overwrite(spark.createDataFrame([(1,)], "id int"))
    first = t.current_path()
    t.overwrite(t.read().withColumn("id", F.col("id") + 1))  # reads v1 while writing v2
    assert t.versions() == [1, 2] and t.read().collect()[0].id == 2
    assert spark.read.parquet(first).collect()[0].id == 1


def test_plain_append_accumulates(spark, tmp):
    t = PathTable(spark, f"{tmp}/a")
    t.append(spark.createDataFrame([(1,)], "id int"))
    t.append(spark.createDataFrame([(2,)], "id int"))
    assert sorted(r.id for r in t.read().collect()) == [1, 2]
