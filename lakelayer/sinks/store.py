"""Path-based Parquet tables whose versions are lists of live folders.

Every write puts its files aside in a folder of its own (``data/_commit=<n>-<id>/``,
below it one folder per partition value) and then publishes a version: a small file
under ``_versions/`` that names the live folders. Only publishing changes what readers
see. A job that fails leaves files that no version names, and the former version
stays readable; a reader of the former version is not disturbed by a new one.

* ``append``: adds a folder. With a ``batch_id`` the folders of an earlier run of that
  batch leave the list in the same step.
* ``overwrite``: only the new folder is live.
* ``overwrite_partitions``: the partitions present in the frame are replaced; an empty
  frame changes nothing; a NULL partition value is its own partition.
* ``replace_where``: partitions that satisfy a predicate leave, the frame's rows come in.

A version also holds the table's schema (so reading infers nothing, and partition
values keep their types), the number under which each batch was first committed, and a
few notes of the caller. Folders that neither of the last ``keep_versions`` versions names
are deleted after a commit. One writer per table is assumed: a version that exists
already is never replaced, so of two writers the slower one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "_batch_id"
COMMIT_COL = "_commit"


class ConcurrentCommitError(RuntimeError):
    pass


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath, _ = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


class PathTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_by: list[str] | tuple[str, ...] = (),
        fmt: str = "parquet",
        rebalance: bool = True,
        keep_versions: int = 2,
        compression: str | None = None,
    ):
        """``rebalance``: cluster rows by the partition columns before a
        partitioned write. Turn it off when the partition columns take only a
        few values per write (a batch id and a status): every task then writes
        at most that many files anyway, and the shuffle would be wasted, or where the rows come clustered.
        ``compression``: the files' codec, where the session's default is not meant."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self.fmt = fmt
        self.rebalance = rebalance
        self.keep_versions = max(1, keep_versions)
        self.compression = compression

    # ---- versions -------------------------------------------------------
    def _names(self, path: str) -> list[str]:
        fs, hpath, _ = _fs_and_path(self.spark, path)
        return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(f"{self.root}/_versions") if n.startswith("v") and n.endswith(".json"))

    def _version_file(self, v: int) -> str:
        return f"{self.root}/_versions/v{v:08d}.json"

    def _manifest(self, v: int | None = None) -> dict | None:
        if v is None:
            vs = self.versions()
            if not vs:
                return None
            v = vs[-1]
        fs, hpath, jvm = _fs_and_path(self.spark, self._version_file(v))
        stream = fs.open(hpath)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self.versions())

    def version(self) -> int:
        vs = self.versions()
        return vs[-1] if vs else 0

    def current_path(self) -> str | None:
        """Folder of the current version's files; the data folder if there are several."""
        m = self._manifest()
        if m is None:
            return None
        commits = {c for c, _ in m["live"]}
        return f"{self.root}/data/{COMMIT_COL}={commits.pop()}" if len(commits) == 1 else f"{self.root}/data"

    def partitions(self) -> list[str]:
        """The live folders below their commits, as ``month=2024-01``."""
        m = self._manifest()
        return sorted({leaf for _, leaf in m["live"]}) if m else []

    def folders(self, leaf: str) -> list[str]:
        """Paths that hold the rows of one partition."""
        return sorted(self._path(c, x) for c, x in self._manifest()["live"] if x == leaf)

    def notes(self) -> dict:
        m = self._manifest()
        return dict(m["notes"]) if m else {}

    def batch_numbers(self) -> dict[str, int]:
        """The version that first held each batch."""
        m = self._manifest()
        return dict(m["batches"]) if m else {}

    def batch_reruns(self) -> dict[str, int]:
        """Of the batches that were written again: the version of the last run."""
        m = self._manifest()
        return dict(m["reruns"]) if m else {}

    def _path(self, commit: str, leaf: str) -> str:
        return f"{self.root}/data/{COMMIT_COL}={commit}" + (f"/{leaf}" if leaf else "")

    # ---- reads ----------------------------------------------------------
    def read(self, version: int | None = None, after: int | None = None, with_commit: bool = False) -> DataFrame:
        """The current (or an older kept) version. ``after``: only rows committed after that
        version. ``with_commit`` keeps the number of the commit that wrote each row."""
        m = self._manifest(version)
        if m is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        schema = T.StructType.fromJson(m["schema"])
        live = [(c, leaf) for c, leaf in m["live"] if after is None or int(c[:8]) > after]
        full = T.StructType(schema.fields + [T.StructField(COMMIT_COL, T.StringType())])
        if live:
            whole = {c: set(leaves) for c, leaves in m["leaves"].items()}
            kept: dict[str, set] = {}
            for c, leaf in live:
                kept.setdefault(c, set()).add(leaf)
            # A commit that is live as a whole is one path.
            paths = [p for c, leaves in kept.items() for p in ([self._path(c, "")] if leaves == whole[c] else [self._path(c, x) for x in sorted(leaves)])]
            df = self.spark.read.format(self.fmt).schema(full).option("basePath", f"{self.root}/data").load(paths)
        else:
            df = self.spark.createDataFrame([], full)
        df = df.select(*[f"`{f.name}`" for f in schema.fields], COMMIT_COL)
        return df.withColumn(COMMIT_COL, F.substring(COMMIT_COL, 1, 8).cast("long")) if with_commit else df.drop(COMMIT_COL)

    # ---- writes ---------------------------------------------------------
    def _write_aside(self, df: DataFrame, number: int) -> tuple[str, list[str]]:
        cols = self.partition_by
        if cols and self.rebalance:
            # Group rows by partition value before writing, so each task writes
            # few directories (no small-file explosion); AQE splits a hot
            # partition value into several advisory-sized tasks and coalesces
            # small ones.
            df = df.hint("rebalance", *cols)
        commit = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        w = df.write.format(self.fmt).mode("error")
        w = w.option("compression", self.compression) if self.compression else w
        (w.partitionBy(*cols) if cols else w).save(self._path(commit, ""))
        leaves = [""]
        for _ in cols:
            leaves = [f"{leaf}/{n}".lstrip("/") for leaf in leaves for n in self._names(self._path(commit, leaf)) if "=" in n]
        return commit, sorted(leaves)

    def commit(
        self,
        df: DataFrame | None,
        replaces: Callable[[str, set], bool],
        batch_id: str | None = None,
        notes: dict | None = None,
    ) -> int:
        """Write ``df`` aside and publish a version without the live folders for which
        ``replaces(leaf, new_leaves)`` holds. Returns the version's number."""
        old = self._manifest() or {"live": [], "leaves": {}, "batches": {}, "reruns": {}, "notes": {}, "schema": None}
        number = old.get("version", 0) + 1
        commit, leaves = self._write_aside(df, number) if df is not None else (None, [])
        live = [[c, leaf] for c, leaf in old["live"] if not replaces(leaf, set(leaves))] + [[commit, leaf] for leaf in leaves]
        schema = old["schema"]
        if df is not None:
            data = [f for f in df.schema.fields if f.name not in self.partition_by]
            fields = {f.name: T.StructField(f.name, f.dataType, True) for f in data}
            if schema is not None and live != [[commit, leaf] for leaf in leaves]:
                stored = T.StructType.fromJson(schema).fields
                fields = {f.name: f for f in stored if f.name not in self.partition_by} | {k: v for k, v in fields.items() if k not in {f.name for f in stored}}
            parts = [T.StructField(c, df.schema[c].dataType, True) for c in self.partition_by]
            schema = T.StructType([*fields.values(), *parts]).jsonValue()
        batches, reruns = dict(old["batches"]), dict(old["reruns"])
        if batch_id is not None and batches.setdefault(str(batch_id), number) != number:
            reruns[str(batch_id)] = number
        commits = {c for c, _ in live}
        manifest = {
            "version": number,
            "partition_by": self.partition_by,
            "schema": schema,
            "live": live,
            "leaves": {c: x for c, x in {**old["leaves"], commit: leaves}.items() if c in commits},
            "batches": batches,
            "reruns": reruns,
            "notes": {**old["notes"], **(notes or {})},
        }
        self._publish(manifest)
        self._clean()
        return number

    def _publish(self, manifest: dict) -> None:
        """The version's file appears under its name complete or not at all."""
        fs, target, jvm = _fs_and_path(self.spark, self._version_file(manifest["version"]))
        aside = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(aside, target):
            fs.delete(aside, False)
            raise ConcurrentCommitError(f"version {manifest['version']} of {self.root} exists already")

    def _clean(self) -> None:
        """Delete versions beyond the kept ones and folders that no kept version names:
        replaced ones, and those of attempts that failed."""
        vs = self.versions()
        kept = [self._manifest(v) for v in vs[-self.keep_versions:]]
        named = {(c, leaf) for m in kept for c, leaf in m["live"]}
        commits = {c for c, _ in named}

        def delete(path: str) -> None:
            fs, hpath, _ = _fs_and_path(self.spark, path)
            fs.delete(hpath, True)

        for v in vs[: -self.keep_versions]:
            for c, leaf in self._manifest(v)["live"]:
                if c in commits and (c, leaf) not in named:
                    delete(self._path(c, leaf))
            delete(self._version_file(v))
        for name in self._names(f"{self.root}/data"):
            commit = name.partition("=")[2]
            if commit not in commits and int(commit[:8]) <= vs[-1]:
                delete(self._path(commit, ""))

    def overwrite(self, df: DataFrame, notes: dict | None = None) -> int:
        """Write ``df`` as the next version; the previous one stays readable."""
        return self.commit(df, lambda leaf, new: True, notes=notes)

    def overwrite_partitions(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Replace only the partitions present in ``df``."""
        if partition_by:
            self.partition_by = list(partition_by)
        if not self.partition_by:
            raise ValueError("overwrite_partitions needs partition columns")
        return self.commit(df, lambda leaf, new: leaf in new)

    def append(self, df: DataFrame, batch_id: str | None = None) -> int:
        """Append rows. With ``batch_id`` the rows are tagged and the write replaces
        everything an earlier run of that batch wrote, whatever its other
        partition values were."""
        if batch_id is None:
            return self.commit(df, lambda leaf, new: False)
        if BATCH_COL not in self.partition_by:
            self.partition_by = [BATCH_COL, *self.partition_by]
        tagged = df.withColumn(BATCH_COL, F.lit(str(batch_id)))
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        folder = f"{BATCH_COL}={escape(str(batch_id))}"
        return self.commit(tagged, lambda leaf, new: folder in leaf.split("/"), batch_id=batch_id)

    def partition_values(self) -> DataFrame:
        """One row per live partition: its folder (``_leaf``) and its typed values."""
        m = self._manifest()
        unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        schema = T.StructType.fromJson(m["schema"])
        rows = []
        for leaf in self.partitions():
            values = [unescape(x.partition("=")[2]) for x in leaf.split("/")] if leaf else []
            rows.append((leaf, *(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values)))
        cols = m["partition_by"]
        df = self.spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in ["_leaf", *cols]]))
        return df.select("_leaf", *[F.col(c).cast(schema[c].dataType).alias(c) for c in cols])

    def replace_where(self, df: DataFrame | None, predicate: Column | str) -> int:
        """In one version, partitions for which ``predicate`` (over the partition columns)
        holds leave and the rows of ``df`` come in. Every row of ``df`` must satisfy the
        predicate. With ``df`` None the partitions are deleted."""
        if not self.partition_by:
            raise ValueError("replace_where needs partition columns")
        cond = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
        if df is not None and not df.filter(~cond).isEmpty():
            raise ValueError("rows outside the replaced range")
        gone = {r["_leaf"] for r in self.partition_values().filter(cond).select("_leaf").collect()} if self.exists() else set()
        return self.commit(df, lambda leaf, new: leaf in gone)
