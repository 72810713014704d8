"""Tables as versioned parquet directories.

A table is a root folder of versions ``v=<n>``; each version is a list of parts ``a=<m>``,
each written by one Spark job. A part counts only once its job has committed (Spark's
``_SUCCESS`` marker), so a write that dies, even half-way through its commit, is invisible
and is simply redone by the next run. Replace and upsert write part 0 of a new version (the
current version is the highest one whose part 0 is committed), so readers never see a
table being rewritten; an append adds the next part to the current version. Single writer
per table; old versions stay until removed by the operator.

A write may carry the name of the run it belongs to (``a=<m>-<run>``). The name is committed with the rows, so
a run that is started again after a failure finds which of its writes are done, and does each of them once.

Every write is a Spark job, reads are plain parquet scans with pruning and pushdown, and
finding the current version is a directory listing (no job).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.aggs import observe_count
from recordlake.operators.project import normalize_types
from recordlake.sinks.upsert import upsert_frames
from recordlake.sources import fs

_VERSION_DIR = re.compile(r"^v=(\d+)$")
_PART_DIR = re.compile(r"^a=(\d+)(?:-\w+)?$")
_RUN = re.compile(r"^\w+$")


class LakeTable:
    """A versioned parquet table at ``root`` (any Hadoop-compatible path)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- catalogue ---------------------------------------------------------------------
    def _data_path(self, version: int) -> str:
        return f"{self.root}/v={version:06d}"

    def _versions(self) -> list[int]:
        """All version directories, committed or not, ascending."""
        found = (_VERSION_DIR.match(n) for n in fs.list_dirs(self.spark, self.root))
        return sorted(int(m.group(1)) for m in found if m)

    def _part_path(self, version: int, part: int, run: str | None = None) -> str:
        if run is not None and not _RUN.match(run):
            raise ValueError(f"the name of a run has letters, digits and underscores: {run!r}")
        return f"{self._data_path(version)}/a={part:06d}" + (f"-{run}" if run else "")

    def _parts(self, version: int) -> list[int]:
        """All part directories of a version, committed or not, ascending."""
        found = (_PART_DIR.match(n) for n in fs.list_dirs(self.spark, self._data_path(version)))
        return sorted(int(m.group(1)) for m in found if m)

    def _first_part(self, version: int) -> str | None:
        """Path of a version's part 0, or None if it is not committed."""
        marks = fs.glob(self.spark, f"{self._data_path(version)}/a=000000*/_SUCCESS")
        return marks[0].rsplit("/", 1)[0] if marks else None

    def part_of(self, run: str) -> str | None:
        """Path of the committed part that ``run`` wrote, in any version, or None."""
        marks = fs.glob(self.spark, f"{self.root}/v=*/a=*-{run}/_SUCCESS")
        return marks[0].rsplit("/", 1)[0] if marks else None

    def _done(self, run: str | None) -> Observation | None:
        """The row count of what ``run`` has written, or None if it has not."""
        part = self.part_of(run) if run else None
        if part is None:
            return None
        counted, obs = observe_count(self.spark.read.parquet(part), f"done_{run}")
        counted.write.format("noop").mode("overwrite").save()
        return obs

    def _committed_parts(self, version: int) -> list[str]:
        """Paths of the committed parts of a version, from one listing of the markers."""
        marks = fs.glob(self.spark, f"{self._data_path(version)}/a=*/_SUCCESS")
        return [m.rsplit("/", 1)[0] for m in marks]

    def current_version(self) -> int | None:
        """Latest version whose first part is committed, or None when the table does not exist."""
        for v in reversed(self._versions()):
            if self._first_part(v):
                return v
        return None

    def exists(self) -> bool:
        """A metadata probe; never treats a read error as "missing"."""
        return self.current_version() is not None

    def _next_version(self) -> int:
        vs = self._versions()
        return (vs[-1] if vs else 0) + 1

    # -- reads -------------------------------------------------------------------------
    def read(self) -> DataFrame:
        """The current version as a parquet scan."""
        v = self.current_version()
        if v is None:
            raise FileNotFoundError(f"table {self.root} does not exist")
        return self.spark.read.parquet(*self._committed_parts(v))

    def read_or_empty(self, schema: T.StructType) -> DataFrame:
        """The table, or an empty frame of ``schema`` when it does not exist yet (Q4)."""
        if not self.exists():
            return self.spark.createDataFrame([], schema)
        return self.read()

    # -- writes ------------------------------------------------------------------------
    def create_or_replace(self, df: DataFrame, run: str | None = None) -> Observation:
        """K3: write ``df`` as a new version (safe even when ``df`` reads this table)."""
        v = self._next_version()
        counted, obs = observe_count(df, f"replace_{v}")
        counted.write.mode("errorifexists").parquet(self._part_path(v, 0, run))
        return obs

    def _align(self, df: DataFrame, target: T.StructType) -> DataFrame:
        extra = [c for c in df.columns if c not in target.fieldNames()]
        if extra:
            raise ValueError(f"columns not in table {self.root}: {extra}")
        have = set(df.columns)
        return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in target.fields])

    def append(self, df: DataFrame, run: str | None = None) -> Observation:
        """K4: append rows, columns matched by name (missing ones null).

        With ``run``, rows that this run has appended before stay as they are: nothing is written, and the count is theirs.
        """
        v = self.current_version()
        if v is None:
            raise FileNotFoundError(f"table {self.root} does not exist")
        done = self._done(run)
        if done is not None:
            return done
        target = self.spark.read.parquet(self._first_part(v)).schema
        part = self._parts(v)[-1] + 1
        counted, obs = observe_count(self._align(df, target), f"append_{v}_{part}")
        counted.write.mode("errorifexists").parquet(self._part_path(v, part, run))
        return obs

    def create_if_missing_or_append(self, df: DataFrame, run: str | None = None) -> Observation:
        """K5: the first write creates the table, later ones append; ``run`` as in ``append``."""
        if self.exists():
            return self.append(df, run)
        return self.create_or_replace(df, run)

    def upsert(self, changes: DataFrame, keys, order_col: str | None = None,
               update_cols: list[str] | None = None) -> tuple[Observation, DataFrame]:
        """K6/K7: keyed upsert into a new version; returns (row count, rejected null keys).

        A missing table is created from the deduped changes, by the same rules: with
        ``update_cols`` the other columns come from the first change of a key.
        """
        if not self.exists():
            cols = [c for c in changes.columns if c != order_col]
            empty = self.spark.createDataFrame([], changes.select(*cols).schema)
            result, rejected = upsert_frames(empty, changes, keys, order_col, update_cols)
        else:
            result, rejected = upsert_frames(self.read(), changes, keys, order_col, update_cols)
        return self.create_or_replace(result), rejected


def batch_path(batch_dir: str, stamp: _dt.datetime | str) -> str:
    """Where the batch of ``stamp`` (``yyyyMMdd_HHmmss``) is written."""
    name = stamp if isinstance(stamp, str) else stamp.strftime("%Y%m%d_%H%M%S")
    return f"{batch_dir.rstrip('/')}/batch_{name}.parquet"


def batch_written(spark: SparkSession, batch_dir: str, stamp: _dt.datetime | str) -> bool:
    """Whether ``write_batch`` has committed the batch of ``stamp``."""
    return fs.exists(spark, f"{batch_path(batch_dir, stamp)}/_SUCCESS")


def write_batch(df: DataFrame, batch_dir: str, stamp: _dt.datetime | str, replace_unfinished: bool = False) -> str:
    """K1/K2: normalize types (P5) and write ``batch_<yyyyMMdd_HHmmss>.parquet`` under
    ``batch_dir`` (any Hadoop-compatible URI). Returns the batch path.

    The batch is a directory of part files; an existing batch of the same name is an error,
    never silently overwritten. ``replace_unfinished`` says that a directory of that name without the marker of a
    committed job is what a failed attempt of the same write left; it is replaced.
    """
    path = batch_path(batch_dir, stamp)
    unfinished = replace_unfinished and not batch_written(df.sparkSession, batch_dir, stamp)
    normalize_types(df).write.mode("overwrite" if unfinished else "errorifexists").parquet(path)
    return path


class PartitionedTable:
    """A parquet table in partitions of its key, for upserts that rewrite only the partitions they touch (K6, K7).

    ``partition`` is a SQL expression of the key columns, such as ``date_format(day, 'yyyy-MM')``; it is stored as the
    partition column ``part`` and not returned by reads. An upsert reads the partitions that hold keys of its changes, joins
    them with the changes, and replaces them by Spark's dynamic partition overwrite: new files are written aside
    and moved in when the job commits. An upsert that dies before leaves the table as it was; one that dies while
    partitions are moved is completed by running it again, since the same changes applied twice give the same rows.
    Single writer per table.
    """

    PART = "part"

    def __init__(self, spark: SparkSession, root: str, keys, partition: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.partition = partition

    def exists(self) -> bool:
        """A metadata probe for a committed first write."""
        return fs.exists(self.spark, f"{self.root}/_SUCCESS")

    def _scan(self) -> DataFrame:
        # partition values stay text, also where they look like numbers
        schema = self.spark.read.parquet(self.root).schema
        fields = [T.StructField(f.name, T.StringType() if f.name == self.PART else f.dataType) for f in schema]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.root)

    def read(self) -> DataFrame:
        return self._scan().drop(self.PART)

    def touched(self, changes: DataFrame) -> DataFrame:
        """The stored rows of the partitions that hold keys of ``changes``: a scan of those folders alone.

        Partition values are collected, at most as many as the table has folders.
        """
        values = [r[0] for r in changes.select(F.expr(self.partition).cast("string")).distinct().collect()]
        wanted = F.col(self.PART).isin([v for v in values if v is not None])
        if None in values:
            wanted = F.coalesce(wanted, F.lit(False)) | F.col(self.PART).isNull()
        return self._scan().where(wanted).drop(self.PART)

    def upsert(self, changes: DataFrame, keys=None, order_col: str | None = None,
               update_cols: list[str] | None = None) -> tuple[Observation, DataFrame]:
        """Keyed upsert of the touched partitions; returns (rows written, rejected null keys). A missing table is created."""
        if keys is not None and ([keys] if isinstance(keys, str) else list(keys)) != self.keys:
            raise ValueError(f"table {self.root} has the keys {self.keys}")
        stored = self.exists()
        if stored:
            base = self.touched(changes)
        else:
            base = self.spark.createDataFrame([], changes.select(*[c for c in changes.columns if c != order_col]).schema)
        result, rejected = upsert_frames(base, changes, self.keys, order_col, update_cols)
        counted, obs = observe_count(result.withColumn(self.PART, F.expr(self.partition).cast("string")), "upsert")
        counted = counted.hint("rebalance", self.PART)  # few files a partition; AQE splits what is too large for one
        # the first write replaces whatever an unfinished one left, and marks the table; later ones replace partitions
        mode = "dynamic" if stored else "static"
        counted.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(self.PART).parquet(self.root)
        return obs, rejected
