"""Token-id files: flat unsigned integers with 64-bit document offsets.

``write`` range-partitions the documents by id, and each task streams its
partition into three files of the shared folder:

* ``.ids``: the ids of its documents one after another, unsigned 16-bit if the
  vocabulary (with the end id) fits, else unsigned 32-bit, little-endian;
* ``.offsets``: ``n_docs + 1`` unsigned 64-bit positions in that file;
* ``.docs``: the document ids, signed 64-bit (``NULL_ID`` for a null id).

The manifest has one row per part, committed by Spark's writer: a task attempt
that is lost leaves files which no manifest row names. A part's base (ids and
documents before it) is the prefix sum over the parts in order.
``read`` maps the files into memory where they are local, else reads ranges.

Defined cases: a null or empty text has only the end id; null document ids come
first; repeated ids are kept, ordered by the hash of their text; an empty table
has a manifest without rows; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import filesystem, narrow, qualified
from lakelayer.llm.pieces import encoder
from lakelayer.session import scratch_path

NULL_ID = -(2**63)
MANIFEST = "part int, name string, width int, n_docs long, n_ids long"
#: Ids that a reading task holds at a time; a longer document is held alone.
READ_IDS = 1_000_000


def write(docs: DataFrame, tokenizer_path: str, end_id: int, out_dir: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the files and the manifest; returns their folder."""
    spark = docs.sparkSession
    out_dir = qualified(spark, out_dir or scratch_path(spark, "token-ids"))

    def store(batches):
        fs, folder = filesystem(out_dir)
        fs.create_dir(f"{folder}/data", recursive=True)
        enc = encoder(tokenizer_path)
        width = 2 if max(enc.vocab_size - 1, end_id) < 2**16 else 4
        end = np.asarray([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        name = f"data/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        n_docs = n_ids = 0
        sinks = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if sinks is None:
                sinks = [fs.open_output_stream(f"{folder}/{name}.{kind}") for kind in ("ids", "offsets", "docs")]
                sinks[1].write(np.zeros(1, "<u8").tobytes())
            ids = [enc.encode(t) + end for t in batch.column("text").to_pylist()]
            ends = n_ids + np.cumsum([len(x) // 4 for x in ids], dtype="<u8")
            flat = np.frombuffer(b"".join(ids), "<u4")
            sinks[0].write(flat.astype(f"<u{width}").tobytes())
            sinks[1].write(ends.astype("<u8").tobytes())
            sinks[2].write(batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs += batch.num_rows
            n_ids = int(ends[-1])
        if sinks:
            for s in sinks:
                s.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "name": [name], "width": [width], "n_docs": [n_docs], "n_ids": [n_ids]},
                schema=pa.schema([("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    rows = narrow(docs, id_col, text_col).withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    rows.select("doc_id", "text").mapInArrow(store, MANIFEST).write.parquet(f"{out_dir}/manifest")
    return out_dir


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The parts with their bases; as many rows as the writing job had tasks."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return parts.select("*", *(F.coalesce(F.sum(f"n_{k}").over(before), F.lit(0)).alias(f"base_{k}") for k in ("docs", "ids")))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    folder = qualified(spark, folder)

    def load(batches):
        fs, root = filesystem(folder)
        local = fs.type_name == "local"

        def part_of(name: str, kind: str, dtype: str, lo: int, hi: int) -> np.ndarray:
            size = np.dtype(dtype).itemsize
            if local:
                return np.memmap(f"{root}/{name}.{kind}", dtype=dtype, mode="r", offset=lo * size, shape=(hi - lo,)) if hi > lo else np.empty(0, dtype)
            with fs.open_input_file(f"{root}/{name}.{kind}") as f:
                return np.frombuffer(f.read_at((hi - lo) * size, lo * size), dtype)

        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_docs"]
                offsets = np.asarray(part_of(row["name"], "offsets", "<u8", 0, n + 1)).astype(np.int64)
                doc_ids = part_of(row["name"], "docs", "<i8", 0, n)
                at = 0
                while at < n:
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + READ_IDS, "right")) - 1)
                    to = min(to, n)
                    ids = part_of(row["name"], "ids", f"<u{row['width']}", int(offsets[at]), int(offsets[to])).astype("<u4")
                    cuts = (offsets[at:to + 1] - offsets[at]).tolist()
                    keys = np.asarray(doc_ids[at:to])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64(), mask=keys == NULL_ID),
                            pa.array(row["base_ids"] + offsets[at:to]),
                            pa.array(np.diff(offsets[at:to + 1])),
                            pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    at = to

    parts = manifest(spark, folder)
    n = parts.count()
    return parts.repartition(max(1, n)).mapInArrow(load, "doc_id long, start long, n_tokens long, ids binary")
