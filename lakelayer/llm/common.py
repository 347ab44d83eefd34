"""Helpers shared by the training-data operators."""

from __future__ import annotations

from urllib.parse import urlparse

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.session import scratch_path

#: White space of the operators' word definition ``[^\x20\x09-\x0D]+``.
SPACES = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy", **options) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: the
    lineage is cut and every later stage sees the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that extra
    columns of the caller cannot clash with the operator's own."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a full URI, resolved by the session's default file system, so that
    Spark's writers and ``filesystem`` on any worker mean the same place."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hpath).toString()


#: Spark's names for object stores, and the ones that the Arrow library knows.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, given as a full URI (see ``qualified``)."""
    parsed = urlparse(uri)
    if parsed.scheme == "file":
        return pafs.LocalFileSystem(), parsed.path
    if not parsed.scheme:
        raise ValueError(f"{uri} names no file system; qualify it on the driver first")
    scheme = _SCHEMES.get(parsed.scheme, parsed.scheme)
    if scheme == "s3":
        # Region and credentials come from the environment, as for Spark's own client.
        return pafs.S3FileSystem(), f"{parsed.netloc}{parsed.path}"
    return pafs.FileSystem.from_uri(parsed._replace(scheme=scheme).geturl())
