"""Catalog table, Parquet, JSON Lines and JDBC sources.

All are thin on purpose: the scan, its column pruning and filter pushdown are
Spark's. What is added is what a large job needs: a schema for JSON so the
inference pass over the whole input is skipped, and the partitioned JDBC form
so a large table is read by many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakelayer.contracts import Contract


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by 1-, 2- or 3-part name."""
    return spark.read.table(name)


def read_parquet(spark: SparkSession, path: str | list[str], merge_schema: bool = False) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | Contract | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """JSON Lines. With a schema (or a contract, typed schema) no inference pass runs."""
    r = spark.read.option("multiLine", str(multi_line).lower())
    if isinstance(schema, Contract):
        schema = schema.typed_schema()
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """JDBC table. Give ``partition_column`` and bounds to split the read into
    ``num_partitions`` range queries; without them the table is one task."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        return spark.read.jdbc(
            url=url,
            table=table,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
            properties=props,
        )
    return spark.read.jdbc(url=url, table=table, properties=props)
