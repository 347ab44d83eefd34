"""Incremental Bronze ingestion with Structured Streaming.

New CSV files landing in a directory are read by the file stream source with
the contract's raw schema, typed and classified by the same projection as the
batch job, and written by ``foreachBatch`` into the Bronze path table. The
stream's id and the micro-batch id form the batch id, so a retried micro-batch
replaces its own rows and a stream with a new checkpoint adds to what is there;
the checkpoint records which files were consumed.

``trigger="available_now"`` processes everything present and stops, which is
how a scheduled daily run uses it.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakelayer.contracts import Contract, get_contract
from lakelayer.operators import quarantine as Q
from lakelayer.operators.contract import CORRUPT_COL, apply_contract
from lakelayer.plans.bronze import INGESTED_AT
from lakelayer.sinks.store import BATCH_COL, PathTable
from lakelayer.sources.csv import SOURCE_FILE_COL, csv_options


def _stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The stream's id, which Spark keeps in its checkpoint: a restart has the same
    one, a new checkpoint another."""
    lines = spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").collect()
    return json.loads(lines[0][0])["id"]


def bronze_stream(
    spark: SparkSession,
    contract: Contract | str,
    source_dir: str,
    table_root: str,
    checkpoint_location: str,
    trigger: str = "available_now",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    c = get_contract(contract) if isinstance(contract, str) else contract
    schema = T.StructType(c.raw_schema().fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    reader = csv_options(spark.readStream.schema(schema), c, None)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(source_dir).withColumn(SOURCE_FILE_COL, F.col("_metadata.file_path"))
    typed = apply_contract(raw, c, keep=[SOURCE_FILE_COL])
    tagged = Q.with_status(typed).withColumn(INGESTED_AT, F.current_timestamp())

    def write_batch(batch_df, epoch_id: int) -> None:
        table = PathTable(batch_df.sparkSession, table_root, partition_by=[BATCH_COL, Q.STATUS_COL], rebalance=False)
        table.append(batch_df, batch_id=f"{_stream_id(batch_df.sparkSession, checkpoint_location)}-{epoch_id:08d}")

    w = tagged.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()
