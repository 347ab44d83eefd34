"""Contract-driven CSV source.

Every field is read as a string (no inference pass, no cell lost to a failed
conversion) in PERMISSIVE mode with a corrupt-record column. The reader option
``columnPruning=false`` makes the parser tokenise whole lines whatever the
query projects, so a ragged line is flagged even when only two columns are
selected downstream; this removes the need to cache the parsed file.

Fields are matched to file columns by position, as a CSV with a header is read
by default. With ``match_by_name=True`` the header of the first file is read (one
line) and each contract field is located by its ``source_name``; Spark checks the
header of every file against it and fails on a different order, so columns are
never swapped silently (such files are read one order at a time).

Contracts with line breaks in cells (``multi_line``) are read in byte ranges by many
tasks per file (``sources.multiline``); ``split=False`` takes Spark's reader, with one task
per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.contracts import Contract
from lakelayer.operators.contract import CORRUPT_COL, apply_contract
from lakelayer.sources import multiline

SOURCE_FILE_COL = "_source_file"


def _reader(spark: SparkSession, contract: Contract, header: bool | None):
    return csv_options(spark.read, contract, header)


def csv_options(reader, contract: Contract, header: bool | None):
    """The contract's options on a batch or stream reader."""
    r = (
        reader.option("header", str(contract.header if header is None else header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("columnPruning", "false")
        .option("multiLine", str(contract.multi_line).lower())
        .option("escape", '"')
    )
    for k, v in contract.options.items():
        r = r.option(k, v)
    return r


def read_csv_raw(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    header: bool | None = None,
    match_by_name: bool = False,
    split: bool = True,
) -> DataFrame:
    """Raw frame: contract field names, all strings, plus ``_corrupt_record`` (and, for
    files read in ranges, ``_source_file``)."""
    paths = [path] if isinstance(path, str) else list(path)
    in_ranges = split and contract.multi_line and multiline.can_split(contract.options)
    if match_by_name:
        file_header = (
            spark.read.option("header", "true").option("inferSchema", "false").csv(paths[0]).columns
        )
        unknown = [f.header for f in contract.fields if f.header not in file_header]
        if unknown:
            raise ValueError(f"contract {contract.name}: header lacks {unknown}")
        schema = T.StructType(
            [T.StructField(h, T.StringType(), True) for h in file_header] + [T.StructField(CORRUPT_COL, T.StringType(), True)]
        )
        if in_ranges:
            return _parsed_records(spark, paths, contract, schema, True, file_header).select(
                *[F.col(f"`{f.header}`").alias(f.name) for f in contract.fields], CORRUPT_COL, SOURCE_FILE_COL
            )
        df = _reader(spark, contract, True).option("enforceSchema", "false").schema(schema).csv(paths)
        return df.select(*[F.col(f"`{f.header}`").alias(f.name) for f in contract.fields], CORRUPT_COL)
    schema = T.StructType(contract.raw_schema().fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    if in_ranges:
        return _parsed_records(spark, paths, contract, schema, contract.header if header is None else header, None)
    return _reader(spark, contract, header).schema(schema).csv(paths)


def _parsed_records(spark, paths, contract, schema, header, names) -> DataFrame:
    """Records of files read in ranges; with ``names`` every file's header must be these."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, "columnPruning": "false", "escape": '"', **contract.options}
    rows = multiline.records(spark, paths)
    rows = rows.withColumn("_r", F.from_csv("record", _ddl(schema), options))
    if header:
        same = F.lit(True)
        for n in names or []:
            same = same & (F.lower(F.trim(F.coalesce(F.col(f"_r.`{n}`"), F.lit("")))) == n.lower().strip())
        stop = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.col("record"))).cast("boolean")
        rows = rows.filter(F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(stop)).otherwise(F.lit(True)))
    return rows.select("_r.*", F.col(multiline.FILE).alias(SOURCE_FILE_COL))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file each row came from (hidden ``_metadata`` column of file sources)."""
    return df if SOURCE_FILE_COL in df.columns else df.withColumn(SOURCE_FILE_COL, F.col("_metadata.file_path"))


def read_csv_contract(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    header: bool | None = None,
    match_by_name: bool = False,
    source_file: bool = False,
    split: bool = True,
) -> DataFrame:
    """Typed contract read: fields, optional ``_source_file``, ``_corrupt_record``, ``_quarantine_reason``."""
    raw = read_csv_raw(spark, path, contract, header=header, match_by_name=match_by_name, split=split)
    keep = []
    if source_file:
        raw = with_source_file(raw)
        keep = [SOURCE_FILE_COL]
    return apply_contract(raw, contract, keep=keep)
