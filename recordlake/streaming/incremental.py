"""Incremental processing.

``incremental_append`` (I1) replaces "take today's files, append unseen keys" with a
Structured Streaming file source: the checkpoint remembers which files were taken, so no
file is lost at midnight and none is taken twice. Each micro-batch runs the first-wins
append (J5) against everything stored by earlier micro-batches.

Replay rule: ``foreachBatch`` is at-least-once. A stored micro-batch is named by the stream's
query id (Spark keeps it in the checkpoint) and its epoch, ``stream=<id>/batch_id=<N>``; a replay
overwrites only its own folder, and is deduplicated against every other one, so it rewrites the same rows,
null keys included. Several streams may feed one table, and a stream whose checkpoint was lost
starts again under a new id: neither touches what is stored. After a lost checkpoint the source files are
read again; keys that are stored are not appended twice, rows with null keys are, as they match nothing.
A micro-batch counts once its write has committed (``_SUCCESS``); readers never see a crashed epoch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recordlake.functions.scalars import file_segment
from recordlake.operators.history import cut_to_keys
from recordlake.operators.joins import append_first_wins, new_rows, skip_seen
from recordlake.session import scratch_path

STREAM_ID = "stream"
BATCH_ID = "batch_id"


def _committed(spark: SparkSession, table_root: str) -> list[str]:
    """Folders of the committed micro-batches, from one listing of the markers."""
    from recordlake.sources import fs

    marks = fs.glob(spark, f"{table_root}/{STREAM_ID}=*/{BATCH_ID}=*/_SUCCESS")
    return [m.rsplit("/", 1)[0] for m in marks]


def read_stored(spark: SparkSession, table_root: str) -> DataFrame | None:
    """Rows of all committed micro-batches (with ``stream`` and ``batch_id``), or None if nothing yet."""
    paths = _committed(spark, table_root)
    if not paths:
        return None
    return spark.read.option("basePath", table_root).parquet(*paths)


def append_micro_batch(batch: DataFrame, epoch_id: int, table_root: str, keys,
                       file_col: str = "batch_file", stream_id: str | None = None) -> None:
    """One micro-batch of I1: J5 against all other committed micro-batches of the table.

    ``stream_id`` defaults to the id of the running streaming query. What is stored is cut to the batch's keys
    before it is shuffled, since it grows with every batch.
    """
    spark = batch.sparkSession
    own = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not own:
        raise ValueError("append_micro_batch needs the id of the stream")
    folder = f"{STREAM_ID}={own}/{BATCH_ID}={epoch_id}"
    others = [p for p in _committed(spark, table_root) if not p.endswith(f"/{folder}")]
    stored = spark.read.option("basePath", table_root).parquet(*others) if others else None
    if stored is not None:
        stored = cut_to_keys(stored, batch, keys)
    rows = append_first_wins(batch, stored, keys, file_col)
    rows.write.mode("overwrite").parquet(f"{table_root}/{folder}")


def incremental_append(spark: SparkSession, source_dir: str, schema: T.StructType, table_root: str,
                       checkpoint: str, keys, file_col: str = "batch_file",
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start I1 over the parquet files under ``source_dir`` and process what is there now
    (``availableNow``); call ``awaitTermination()`` on the result.
    """
    def sink(df, epoch):
        append_micro_batch(df, epoch, table_root, keys, file_col)

    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir).withColumn(file_col, file_segment(F.col("_metadata.file_path")))
    return (stream.writeStream
            .foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def resume(records: DataFrame, prior_results: DataFrame, key: str) -> DataFrame:
    """Records still to look up (keys of an earlier run are skipped, null matching null)."""
    return skip_seen(records, prior_results, key)


def read_progress(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows persisted by committed ``write_progress`` runs, or None.

    A run counts only once its write job has committed (``_SUCCESS``): a run that died, even
    during its commit, is ignored, and its batches are written again.
    """
    from recordlake.sources import fs

    runs = [m.rsplit("/", 1)[0] for m in fs.glob(spark, f"{root}/run=*/_SUCCESS")]
    if not runs:
        return None
    return spark.read.option("basePath", root).parquet(*runs).drop("run")


def write_progress(df: DataFrame, root: str, batch_col: str = BATCH_ID, commits: int = 10,
                   step: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Persist numbered batches in up to ``commits`` committed runs; returns the rows written.

    A batch is done when a committed run holds it, whatever its neighbours are. The missing batches
    are cut into ranges of batch ids, each written to a ``run=<id>`` folder by a job of its own,
    in ascending order: when a later one fails, the earlier ones remain and the next call writes only what is
    missing. The number of runs is bounded, however many batches there are. Batches must be whole: rows of one
    batch in two calls would leave the second call's out.

    ``step`` is the work that each range is to have done (look-ups, extraction) and must keep ``batch_col``. With it,
    ``df`` is evaluated once: the missing batches are written down in the shared folder, sorted by batch id in each file, and a
    commit reads its range alone (row groups of other ranges are skipped) and applies ``step`` to it, so a
    failure of the work costs that range and those after it. Without it, ``df`` is the finished work and each
    commit evaluates its range of it.
    """
    from recordlake.sources import fs

    spark = df.sparkSession
    done = read_progress(spark, root)
    todo = df if done is None else df.join(done.select(batch_col).distinct(), batch_col, "left_anti").select(*df.columns)
    if step is None:
        return _write_ranges(todo, *todo.agg(F.min(batch_col), F.max(batch_col)).first(), root, batch_col, commits)
    path = scratch_path(spark, "todo")
    bounds = Observation("bounds")
    try:
        (todo.observe(bounds, F.min(batch_col).alias("lo"), F.max(batch_col).alias("hi"))
         .sortWithinPartitions(batch_col).write.parquet(path))
        todo = spark.read.schema(todo.schema).parquet(path)
        return _write_ranges(todo, bounds.get["lo"], bounds.get["hi"], root, batch_col, commits, step)
    finally:
        fs.delete(spark, path)


def _write_ranges(todo: DataFrame, lo: int | None, hi: int | None, root: str, batch_col: str, commits: int,
                  step: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """One committed run per range of batch ids, ascending; returns the rows written."""
    import time
    import uuid

    from recordlake.operators.aggs import observe_count

    if lo is None:
        return 0
    width = -(-(hi - lo + 1) // commits)
    written = 0
    for start in range(lo, hi + 1, width):
        part = todo.where((F.col(batch_col) >= start) & (F.col(batch_col) < start + width))
        counted, obs = observe_count(step(part) if step else part, "progress")
        run = f"run={time.strftime('%Y%m%d%H%M%S')}-{start:012d}-{uuid.uuid4().hex[:8]}"
        counted.write.mode("errorifexists").parquet(f"{root}/{run}")
        written += obs.get["rows"]
    return written


def incremental_enrich(source: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """I4: only source rows whose key is not in the target yet."""
    return source if target is None else new_rows(source, target.select(key), key)
