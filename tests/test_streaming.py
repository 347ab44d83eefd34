"""Incremental Bronze ingestion with a file stream and foreachBatch."""

from pyspark.sql import functions as F

from lakelayer.contracts import get_contract
from lakelayer.sinks.store import PathTable
from lakelayer.streaming.ingest import bronze_stream


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_available_now_picks_up_new_files(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    c = get_contract("supplier_raw")
    _write(src / "a.csv", ["1,S1,3,10.5", "2,S2,n/a,1.0", ",S3,4,2.0"])
    root, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    q = bronze_stream(spark, c, str(src), root, ckpt)
    q.awaitTermination(120)
    t = PathTable(spark, root)
    got = {r.seller_id: r._quarantine_reason for r in t.read().collect()}
    assert got == {"1": None, "2": "bad_type:nation_key", None: "missing_required_field:seller_id"}
    _write(src / "b.csv", ["4,S4,5,3.0,EXTRA"])
    q = bronze_stream(spark, c, str(src), root, ckpt)
    q.awaitTermination(120)
    df = t.read()
    assert df.count() == 4  # the first file is not read again
    assert df.filter(F.col("_status") == "quarantine").count() == 3
    assert df.select("_batch_id").distinct().count() == 2
