"""Bronze ingestion: contract read -> quarantine -> one idempotent write.

One job per source file set, one pass over the input:

    typed = contract read (+ _source_file) with _quarantine_reason
    tagged = + _status (clean | quarantine) + _ingested_at
    write tagged, partitioned by (_batch_id, _status), replacing the batch

Clean rows and rejects are pruned reads of that one dataset (``clean`` /
``quarantine`` below); the counts come from ``observe`` on the same write, so
nothing is recomputed, cached or counted in a separate action. Re-running a
batch replaces all its rows, clean and rejected, instead of appending duplicates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.contracts import Contract, get_contract
from lakelayer.operators import quarantine as Q
from lakelayer.sinks.store import BATCH_COL, PathTable
from lakelayer.sources.csv import read_csv_contract

INGESTED_AT = "_ingested_at"


@dataclass
class IngestResult:
    table: PathTable
    batch_id: str
    total_rows: int
    clean_rows: int
    quarantine_rows: int


def bronze_frame(spark: SparkSession, contract: Contract, path: str | list[str], header: bool | None = None, match_by_name: bool = False) -> DataFrame:
    typed = read_csv_contract(spark, path, contract, header=header, match_by_name=match_by_name, source_file=True)
    return Q.with_status(typed).withColumn(INGESTED_AT, F.current_timestamp())


def ingest(
    spark: SparkSession,
    contract: Contract | str,
    path: str | list[str],
    table_root: str,
    batch_id: str,
    header: bool | None = None,
    match_by_name: bool = False,
) -> IngestResult:
    c = get_contract(contract) if isinstance(contract, str) else contract
    # one batch id and two statuses per write: no rebalance shuffle needed
    table = PathTable(spark, table_root, partition_by=[BATCH_COL, Q.STATUS_COL], rebalance=False)
    frame = bronze_frame(spark, c, path, header=header, match_by_name=match_by_name)
    observed, obs = Q.observe_counts(frame, name=f"bronze-{c.name}-{batch_id}")
    table.append(observed, batch_id=batch_id)
    m = obs.get
    return IngestResult(table, batch_id, m["total_rows"], m["clean_rows"], m["quarantine_rows"])


def clean(table: PathTable) -> DataFrame:
    return table.read().filter(F.col(Q.STATUS_COL) == Q.CLEAN).drop(Q.REASON_COL, Q.CORRUPT_COL)


def quarantine(table: PathTable) -> DataFrame:
    return table.read().filter(F.col(Q.STATUS_COL) == Q.QUARANTINE)


def run_all(spark: SparkSession, sources: dict[str, str | list[str]], root: str, batch_id: str, header: bool | None = None, match_by_name: bool = False) -> dict[str, IngestResult]:
    """Ingest several contracts, one after the other, each into ``root/<contract>``.

    A failure stops the remaining ones (the batch can be re-run: each write is
    idempotent per batch id)."""
    return {
        name: ingest(spark, name, path, f"{root.rstrip('/')}/{name}", batch_id, header=header, match_by_name=match_by_name)
        for name, path in sources.items()
    }
