"""Warehouse tables on shared storage (SNK1-SNK4, SNK7, INC2-INC4).

Layout under ``root``::

    <root>/<name>/v=<version>/    parquet data of one table version
    <root>/_ctl/<name>/<number>   pointers; the highest number names the current version

A full refresh writes a *new* version folder and then its pointer, so readers
never see a truncated table and a plan never overwrites the files it reads. A
pointer file is created exclusively, so of two writers that started from the
same pointer one finds the number taken: an upsert then merges again on top of
the newer state, an append into a version that has been replaced fails, and
nothing is lost without an error.

Months of a partitioned table are replaced by Spark's dynamic partition
overwrite: the merged months are written beside the table, a pointer names them
(readers take those months from there), they overwrite the months in place,
and the next pointer ends it. A writer that finds an unfinished replacement
finishes it first.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.incremental import latest_per_key, upsert as _upsert, with_keys
from vaultline.sinks.clustering import ROWS_PER_FILE, clustered

ATTEMPTS = 5
ROWS_PER_TASK = 500_000      # rows and batch keys that a task of a merge compares
FEW_KEYS = 200_000           # batch keys that are broadcast
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _in(col, values: list):
    """Whether ``col`` is one of ``values``, of which None stands for NULL; never NULL itself."""
    found = F.coalesce(col.isin([v for v in values if v is not None]), F.lit(False))
    return found | col.isNull() if None in values else found


class TableStore:
    """Parquet tables under ``root``, each a version folder behind a pointer.
    The current and the previous version are kept."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---------------------------------------------------------------- pointers
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        fs = self._files()
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def _pointer(self, name: str) -> dict | None:
        """The current pointer: number, version, schema, and the replacement
        under way (``months``), if any. Always read anew."""
        for number in reversed([n for n in self._names("_ctl", name) if n.isdigit()]):
            stream = self._files().open(self._path("_ctl", name, number))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            if text.endswith("\n"):                      # else its writer has not finished it
                return {"number": int(number), **json.loads(text)}
        return None

    def _point(self, name: str, after: dict | None, version: str, schema: T.StructType, months: dict | None = None) -> bool:
        """Make ``version`` current if ``after`` still is the newest pointer."""
        number = after["number"] + 1 if after else 0
        try:
            out = self._files().create(self._path("_ctl", name, f"{number:012d}"), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception) or "already exists" in str(e.java_exception):
                return False
            raise
        out.write(bytearray(json.dumps({"version": version, "schema": schema.json(), "months": months}) + "\n", "utf-8"))
        out.close()
        if after and after["version"] != version:
            self._clean(name, {after["version"], version})
        return True

    def _clean(self, name: str, kept: set[str]) -> None:
        for folder in self._names(name):
            if folder.startswith("v=") and folder[2:] not in kept and folder[2:] < min(kept):
                self._files().delete(self._path(name, folder), True)
        for number in [n for n in self._names("_ctl", name) if n.isdigit()][:-2]:
            self._files().delete(self._path("_ctl", name, number), False)

    def state(self, name: str) -> int | None:
        """A number that grows with every change of the table; None where there is none."""
        p = self._pointer(name)
        return p["number"] if p else None

    def current_version(self, name: str) -> str | None:
        p = self._pointer(name)
        return p["version"] if p else None

    def exists(self, name: str) -> bool:
        return self._pointer(name) is not None

    def _current(self, name: str) -> dict:
        p = self._pointer(name)
        if p is None:
            raise FileNotFoundError(f"table {name!r} has no committed version")
        return p

    def location(self, name: str, version: str | None = None) -> str:
        return f"{self.root}/{name}/v={version or self._current(name)['version']}"

    @staticmethod
    def _new_version() -> str:
        """Time-ordered and unique across writers."""
        return f"{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:8]}"

    # ---------------------------------------------------------------- reads
    def read(self, name: str) -> DataFrame:
        """Current rows; the committed schema is applied, so an empty
        (file-less) partitioned version still reads as an empty table."""
        return self._rows(name, self._current(name))

    def _rows(self, name: str, p: dict) -> DataFrame:
        schema, months = T.StructType.fromJson(json.loads(p["schema"])), p["months"]
        df = self.spark.read.schema(schema).parquet(self.location(name, p["version"]))
        if months:
            beside = self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{months['folder']}")
            df = df.filter(~_in(F.col(months["column"]), months["values"])).unionByName(beside)
        return df

    def read_between(self, name: str, ts_col: str, start=None, end=None,
                     partition_col: str = "txn_month") -> DataFrame:
        """Range read of a month-partitioned table: the derived month predicate
        prunes partitions, the timestamp predicate is pushed to the files."""
        from vaultline.functions.columns import month_of, ntz
        df = self.read(name)
        if start is not None:
            df = df.filter((F.col(partition_col) >= month_of(ntz(start)))
                           & (F.col(ts_col) >= ntz(start)))
        if end is not None:
            df = df.filter((F.col(partition_col) <= month_of(ntz(end)))
                           & (F.col(ts_col) < ntz(end)))
        return df

    # ---------------------------------------------------------------- writes
    @staticmethod
    def _layout(df: DataFrame, partition_by: list[str], sort_by: list[str]) -> DataFrame:
        """SNK3/SNK4: rows of a partition value meet in one task, so it gets one
        file, and AQE splits a value beyond the advisory size over several
        tasks (``rebalance``); each file is ordered by the sort keys. Nothing
        is sampled, so the plan runs once."""
        keys = partition_by + sort_by
        if keys:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by or sort_by[:1]])
        return df.sortWithinPartitions(*keys) if sort_by else df

    def _write(self, df: DataFrame, path: str, mode: str, partition_by, sort_by) -> None:
        partition_by, sort_by = _as_list(partition_by), _as_list(sort_by)
        w = self._layout(df, partition_by, sort_by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)

    def overwrite(self, name: str, df: DataFrame, partition_by=None, sort_by=None, cluster_by=None,
                  rows_per_file: int = ROWS_PER_FILE) -> str:
        """SNK1: full refresh into a new version, then switch the pointer; of
        two at once the later switch is current. ``cluster_by`` writes the rows
        beside the table first and deals them to files by ranges of these keys
        (SNK4, ``sinks.clustering``), instead of ``sort_by``."""
        version = self._new_version()
        if cluster_by:
            stage = f"stage={version}"
            df.write.parquet(f"{self.root}/{name}/{stage}")
            staged = self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}/{stage}")
            w = clustered(staged, _as_list(cluster_by), _as_list(partition_by), rows_per_file).write
            (w.partitionBy(*_as_list(partition_by)) if partition_by else w).parquet(self.location(name, version))
            self._files().delete(self._path(name, stage), True)
        else:
            self._write(df, self.location(name, version), "errorifexists", partition_by, sort_by)
        while not self._point(name, self._pointer(name), version, df.schema):
            pass
        return version

    def append(self, name: str, df: DataFrame, partition_by=None, sort_by=None) -> None:
        """SNK2/SNK3: append (month partitions with ``partition_by``). The new
        pointer makes a concurrent upsert merge again; if the table was
        replaced meanwhile, the call fails."""
        p = self._settled(name)
        if p is None:
            self.overwrite(name, df, partition_by, sort_by)
            return
        schema = T.StructType.fromJson(json.loads(p["schema"]))
        self._write(df, self.location(name, p["version"]), "append", partition_by, sort_by)
        now = p
        while not self._point(name, now, p["version"], schema):
            now = self._settled(name)
            if now["version"] != p["version"]:
                raise RuntimeError(f"table {name!r} was replaced during an append; its rows may be missing")

    def upsert(self, name: str, batch: DataFrame, keys, order: Sequence[str] | None = None,
               partition_by: str | None = None, sort_by=None,
               stable_partitions: bool = False) -> None:
        """INC2 on a stored table.

        Unpartitioned: merged result written as a new version. Partitioned:
        only partitions holding a batch row or a replaced key are rewritten;
        the list of touched partition values (NULL is one) is the only thing
        collected and is bounded by the partition count. If another writer
        changed the table meanwhile, the merge is done again on top of that.
        ``stable_partitions`` declares that a key never moves between
        partitions (e.g. a transaction's month), so the touched partitions are
        those of the batch alone and the target's keys need not be scanned.
        Rewritten partitions keep the ``sort_by`` layout.
        """
        keys, sort_by = _as_list(keys), _as_list(sort_by)
        if order:
            batch = latest_per_key(batch, keys, order)
        if self._settled(name) is None:
            self.overwrite(name, batch, partition_by, sort_by)
            return
        # read for its keys, its partitions and its rows: written once
        stage = f"stage={self._new_version()}"
        batch.write.parquet(f"{self.root}/{name}/{stage}")
        try:
            self._merge(name, self.spark.read.schema(batch.schema).parquet(f"{self.root}/{name}/{stage}"),
                        keys, partition_by, sort_by, stable_partitions)
        finally:
            self._files().delete(self._path(name, stage), True)

    def _merge(self, name: str, batch: DataFrame, keys, partition_by, sort_by, stable_partitions: bool) -> None:
        n = batch.count()
        for _ in range(ATTEMPTS):
            p = self._settled(name)
            target = self._rows(name, p)
            rows = batch.select(*target.columns)
            if partition_by is None:
                version = self._new_version()
                merged = _upsert(target, rows, keys, tasks=self._tasks(target, n))
                self._write(merged, self.location(name, version), "errorifexists", None, sort_by)
                if self._point(name, p, version, target.schema):
                    return
                continue
            parts = rows.select(partition_by)
            if not stable_partitions:
                parts = parts.union(with_keys(target.select(*dict.fromkeys([*keys, partition_by])), rows, keys, "left_semi",
                                              self._tasks(target, n)).select(partition_by))
            touched = [r[0] for r in parts.distinct().collect()]
            if not touched:
                return
            old = target.filter(_in(F.col(partition_by), touched))
            merged = _upsert(old, rows, keys, tasks=self._tasks(old, n))
            if self._replace(name, p, merged, partition_by, touched, sort_by):
                return
        raise RuntimeError(f"table {name!r}: other writers changed it during {ATTEMPTS} attempts")

    @staticmethod
    def _tasks(target: DataFrame, n: int) -> int:
        """Tasks that compare the keys of ``target`` with ``n`` keys of a batch; 0: these are few."""
        return -(-(target.count() + n) // ROWS_PER_TASK) if n > FEW_KEYS else 0

    def replace(self, name: str, rows: DataFrame, column: str, values: list, sort_by=None) -> None:
        """Put ``rows`` in the place of the partitions ``values`` of ``column``,
        all at once. ``rows`` may be computed from the table."""
        if not self._replace(name, self._settled(name), rows.select(*self.read(name).columns), column, values, _as_list(sort_by)):
            raise RuntimeError(f"table {name!r}: another writer changed it during a replacement")

    def _replace(self, name: str, p: dict, rows: DataFrame, column: str, values: list, sort_by) -> bool:
        """Put ``rows`` in the place of the partitions ``values`` of ``column``;
        false if the table has changed since the pointer ``p``."""
        months = {"folder": f"months={self._new_version()}", "column": column, "values": values, "sort_by": sort_by}
        self._write(rows, f"{self.root}/{name}/{months['folder']}", "errorifexists", column, sort_by)
        schema = T.StructType.fromJson(json.loads(p["schema"]))
        if not self._point(name, p, p["version"], schema, months):
            self._files().delete(self._path(name, months["folder"]), True)
            return False
        self._settled(name)
        return True

    def _settled(self, name: str) -> dict | None:
        """The current pointer, after a replacement under way has been finished."""
        p = self._pointer(name)
        if p is None or not p["months"]:
            return p
        months, schema = p["months"], T.StructType.fromJson(json.loads(p["schema"]))
        beside = self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{months['folder']}")
        self._write(beside, self.location(name, p["version"]), "overwrite", months["column"], months["sort_by"])
        # partitions that the replacement has left empty
        label = lambda v: NULL_PARTITION if v is None else str(v)                # noqa: E731
        gone = {label(v) for v in months["values"]} - {
            unquote(f.partition("=")[2]) for f in self._names(name, months["folder"])}
        for folder in self._names(name, f"v={p['version']}"):
            if folder.startswith(f"{months['column']}=") and unquote(folder.partition("=")[2]) in gone:
                self._files().delete(self._path(name, f"v={p['version']}", folder), True)
        if self._point(name, p, p["version"], schema):
            # readers of the pointer before may still be at it; what is older goes
            for folder in [f for f in self._names(name) if f.startswith("months=")][:-1]:
                self._files().delete(self._path(name, folder), True)
        return self._pointer(name)


def materialize(df: DataFrame, name: str, how: str = "view", store: TableStore | None = None,
                keys=None, order=None, partition_by=None) -> DataFrame:
    """SNK7: view / table / incremental materialisation of a model."""
    if how == "view":
        df.createOrReplaceTempView(name)
        return df
    if store is None:
        raise ValueError("table and incremental materialisations need a TableStore")
    if how == "table":
        store.overwrite(name, df, partition_by)
    elif how == "incremental":
        store.upsert(name, df, keys, order, partition_by)
    else:
        raise ValueError(f"unknown materialisation {how!r}")
    return store.read(name)


def with_month(df: DataFrame, ts_col: str = "txn_ts", name: str = "txn_month") -> DataFrame:
    """SNK3 helper: yyyyMM partition column."""
    from vaultline.functions.columns import month_of
    return df.withColumn(name, month_of(ts_col))
