"""Replay-safe sinks for the metrics stream.

* History: each epoch is written with ``mode("overwrite")`` to
  ``<base>/run_id=<R>/batch_id=<N>``, in as many files as its rows call for.
  Re-running an epoch after a failure rewrites the same folder, so the effect
  is exactly-once. The layout is ``key=value``, so readers prune by run and
  batch. ``compact_history`` merges finished epochs into few files beside them
  and commits a log entry; ``read_history`` then reads those files and the
  epochs after them.
* Latest state: merge-on-read over the history, i.e. per metrics key the
  values of the highest batch (``max_by``, a partial hash aggregate).
  Nothing is rewritten per epoch; ``compact_latest`` writes a snapshot and
  ``read_latest`` merges the newest snapshot with later epochs only.
* Bulk NDJSON: the search-engine bulk encoding (an action line and a
  document line per row), written as text files per epoch; nulls are kept.

``MetricsBatchWriter`` is the ``foreachBatch`` function: it persists the
epoch once, skips empty epochs, runs every sink, and raises after all sinks
ran if any failed (so the epoch is retried instead of committed with a
lost sink).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark import InheritableThread, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.functions.columns import doc_id, iso_utc
from touchline.operators.metrics import LAST_EVENT
from touchline.schemas import METRIC_KEYS
from touchline.streaming.documents import DOC_KEY
from touchline.streaming.files import Log, file_names, remove, subfolders

# Fixed value: the search index the documents are addressed to.
INDEX_NAME = "football_metrics"
#: Rows of one file of the history.
ROWS_PER_FILE = 1_000_000


def bulk_ndjson(metrics: DataFrame, index: str = INDEX_NAME, now: str | Column | None = None,
                faithful_id: bool = False) -> DataFrame:
    """One row per document: ``doc_id`` and ``bulk`` = action line + '\\n' +
    document line. The document is every metrics column plus ``timestamp``
    (ISO-8601 UTC, processing time unless ``now`` is given). The default id
    adds the team, because one player can appear in both squads; the
    faithful id is ``<match>_<player>``."""
    if now is None:
        ts = iso_utc()
    elif isinstance(now, str):
        ts = F.lit(now)
    else:
        ts = now
    if faithful_id:
        did = doc_id("match_id", "player_id", faithful=True)
    else:
        did = F.concat_ws("_", *[F.coalesce(F.col(c), F.lit("None")) for c in DOC_KEY])
    meta = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), did.alias("_id")).alias("index")))
    body = F.to_json(F.struct(*[F.col(c) for c in metrics.columns if c != LAST_EVENT], ts.alias("timestamp")),
                     {"ignoreNullFields": "false"})
    return metrics.select(did.alias("doc_id"), F.concat_ws("\n", meta, body).alias("bulk"))


def write_bulk_files(metrics: DataFrame, path: str, compression: str = "none", **kw) -> None:
    """Write the bulk body as NDJSON text files (one folder per epoch)."""
    (bulk_ndjson(_files(metrics, ROWS_PER_FILE), **kw).select("bulk")
     .write.mode("overwrite").text(path, compression=compression))


def read_bulk_files(spark: SparkSession, base: str, run_id: str, schema: StructType) -> DataFrame:
    """The documents of a run's bulk files, with the epoch that wrote them. A
    document line holds its own key, so action lines need not be matched."""
    lines = spark.read.option("basePath", base).text(f"{base}/run_id={run_id}")
    docs = lines.filter(~F.startswith("value", F.lit('{"index":')))
    wanted = StructType([f for f in schema.fields if f.name not in ("batch_id", LAST_EVENT)])
    return docs.select(F.from_json("value", wanted).alias("d"), "run_id", "batch_id").select("d.*", "run_id", "batch_id")


def history_path(base: str, run_id: str, batch_id: int) -> str:
    return f"{base}/run_id={run_id}/batch_id={batch_id}"


def _files(df: DataFrame, rows_per_file: int) -> DataFrame:
    """As many partitions, so files, as the rows call for (at least one, at
    most as many as there are), whatever the shuffle that made them. The rows
    are counted first, on an epoch that the writer has persisted."""
    return df.coalesce(max(1, math.ceil(df.count() / rows_per_file)))


def write_history(df: DataFrame, base: str, run_id: str, batch_id: int,
                  rows_per_file: int = ROWS_PER_FILE) -> None:
    """Idempotent per-epoch history write."""
    _files(df, rows_per_file).write.mode("overwrite").parquet(history_path(base, run_id, batch_id))


def _compactions(spark: SparkSession, base: str, run_id: str) -> Log:
    # the name's underscore hides the folder from readers of the base folder
    return Log(spark, f"{base}/_compacted/run_id={run_id}/_log")


def _runs(spark: SparkSession, base: str) -> list[str]:
    return [x[len("run_id="):] for x in subfolders(spark, base, "run_id=")]


def read_history(spark: SparkSession, base: str, run_id: str | None = None) -> DataFrame:
    """All epochs (``run_id``/``batch_id`` become columns); of one run if given,
    whose folder alone is listed then. Compacted epochs are read from their
    merged files."""
    if run_id is None:
        if not subfolders(spark, f"{base}/_compacted"):
            return spark.read.option("basePath", base).parquet(base)
        parts = [read_history(spark, base, r) for r in sorted({*_runs(spark, base), *_runs(spark, f"{base}/_compacted")})]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out
    own = f"{base}/run_id={run_id}"
    merged = _compactions(spark, base, run_id).entry()
    reader = spark.read.option("basePath", base)
    if merged is None:
        return reader.parquet(own if subfolders(spark, own) else base).filter(F.col("run_id") == run_id)
    old = (spark.read.parquet(f"{base}/_compacted/run_id={run_id}/upto={merged['upto']}")
           .withColumn("run_id", F.lit(run_id)))
    later = [f"{own}/{x}" for x in subfolders(spark, own, "batch_id=") if int(x[len("batch_id="):]) > merged["upto"]]
    return old.unionByName(reader.parquet(*later), allowMissingColumns=True) if later else old


def compact_history(spark: SparkSession, base: str, run_id: str, rows_per_file: int = ROWS_PER_FILE) -> int | None:
    """Merge a run's finished epochs into few files, sorted by epoch and match
    so that filters on either skip row groups, and switch ``read_history`` to
    them. The epoch folders stay for readers that list them, until
    ``expire_epochs``. Returns the last epoch merged."""
    upto = _finished_epoch(spark, base, run_id)
    log = _compactions(spark, base, run_id)
    done = log.entry()
    if upto is None or (done and done["upto"] >= upto):
        return done["upto"] if done else None
    rows = read_history(spark, base, run_id).filter(F.col("batch_id") <= upto).drop("run_id")
    files = max(1, math.ceil(rows.count() / rows_per_file))
    (rows.repartitionByRange(files, "batch_id", "match_id").sortWithinPartitions("batch_id", "match_id")
     .write.mode("overwrite").parquet(f"{base}/_compacted/run_id={run_id}/upto={upto}"))
    log.commit(upto, {"upto": upto, "files": files})
    return upto


def expire_epochs(spark: SparkSession, base: str, run_id: str) -> list[int]:
    """Remove epoch folders that a committed compaction holds, and older
    compactions. Only for histories whose readers all use ``read_history``."""
    log = _compactions(spark, base, run_id)
    merged = log.entry()
    if merged is None:
        return []
    own, folder = f"{base}/run_id={run_id}", f"{base}/_compacted/run_id={run_id}"
    epochs = sorted(int(x[len("batch_id="):]) for x in subfolders(spark, own, "batch_id="))
    gone = [n for n in epochs if n <= merged["upto"]]
    for n in gone:
        remove(spark, history_path(base, run_id, n))
    for n in log.numbers()[:-1]:
        log.drop(n)
        remove(spark, f"{folder}/upto={n}")
    return gone


def committed_epoch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last epoch that the query's own commit log has: all its sinks ran."""
    return max((int(n) for n in file_names(spark, f"{checkpoint}/commits") if n.isdigit()), default=None)


def read_last_epoch(spark: SparkSession, base: str, run_id: str, checkpoint: str) -> DataFrame:
    """The newest committed epoch of a run's history alone: in complete mode
    each epoch has every row, so this is the latest state. Epochs without rows
    wrote no folder; one that is written but not committed is not read."""
    last = committed_epoch(spark, checkpoint)
    own = f"{base}/run_id={run_id}"
    epochs = [int(x[len("batch_id="):]) for x in subfolders(spark, own, "batch_id=", finished=True)]
    epochs = [n for n in epochs if last is not None and n <= last]
    if not epochs:
        raise ValueError(f"run {run_id} has no committed epoch in {base}")
    return spark.read.option("basePath", base).parquet(history_path(base, run_id, max(epochs)))


def _finished_epoch(spark: SparkSession, history_base: str, run_id: str) -> int | None:
    """The last epoch before any unfinished one: an epoch folder without its
    marker is still being written, and what comes after it is not final."""
    folder, prefix = f"{history_base}/run_id={run_id}", "batch_id="
    every = {int(x[len(prefix):]) for x in subfolders(spark, folder, prefix)}
    done = {int(x[len(prefix):]) for x in subfolders(spark, folder, prefix, finished=True)}
    below = [n for n in done if n < min(every - done, default=n + 1)]
    merged = _compactions(spark, history_base, run_id).entry()
    return max([*below, *([merged["upto"]] if merged else [])], default=None)


def read_foreign_history(spark: SparkSession, base: str) -> DataFrame:
    """History written by the original job (``<base>/batch_<N>`` folders):
    the batch number is recovered from each row's file path."""
    h = spark.read.parquet(f"{base}/batch_*")
    n = F.regexp_extract(F.col("_metadata.file_path"), r"batch_(\d+)", 1).cast("bigint")
    return h.withColumn("batch_id", n)


def latest_from_history(history: DataFrame, key: Sequence[str] = METRIC_KEYS) -> DataFrame:
    """Latest row per metrics key (and run): every value column is taken
    from the row of the highest ``batch_id`` with ``max_by``. All value
    columns are numbers, so this is a partial hash aggregate over the
    history, not a sort."""
    group = (["run_id"] if "run_id" in history.columns else []) + list(key)
    values = [c for c in history.columns if c not in group and c != "batch_id"]
    return history.groupBy(*group).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])


def _snapshot_batches(spark: SparkSession, snapshot_base: str, run_id: str) -> list[int]:
    """Batch ids of the complete snapshots of a run (folders ``upto=N`` with
    a ``_SUCCESS`` marker), from a file listing on the driver."""
    names = subfolders(spark, f"{snapshot_base}/run_id={run_id}", "upto=", finished=True)
    return sorted(int(x[len("upto="):]) for x in names)


def _with_snapshot(spark: SparkSession, history: DataFrame, snapshot_base: str,
                   run_id: str) -> DataFrame:
    done = _snapshot_batches(spark, snapshot_base, run_id)
    if not done:
        return history
    n = done[-1]
    snap = (spark.read.parquet(f"{snapshot_base}/run_id={run_id}/upto={n}")
            .withColumn("run_id", F.lit(run_id)))
    return snap.unionByName(history.filter(F.col("batch_id") > n))


def read_latest(spark: SparkSession, history_base: str, snapshot_base: str, run_id: str,
                key: Sequence[str] = METRIC_KEYS) -> DataFrame:
    """Latest state of a run = newest snapshot (up to batch N) merged with
    the epochs after N only; the ``batch_id > N`` filter prunes the older
    epoch folders of the run, which are listed but not read."""
    history = read_history(spark, history_base, run_id)
    return latest_from_history(_with_snapshot(spark, history, snapshot_base, run_id), key)


def compact_latest(spark: SparkSession, history_base: str, snapshot_base: str, run_id: str,
                   key: Sequence[str] = METRIC_KEYS) -> int | None:
    """Write a new snapshot of a run's latest state to
    ``<snapshot_base>/run_id=<R>/upto=<N>`` (N = last batch folded in) and
    return N. Each row keeps the ``batch_id`` it came from, so a later merge
    with newer epochs stays correct. A new snapshot is written only to a new
    folder (N above the newest complete snapshot), so a job never overwrites
    what it reads; with nothing new it returns the existing N. Epochs
    committed while it runs are left for the next snapshot, and so is every
    epoch from the first unfinished one on."""
    n = _finished_epoch(spark, history_base, run_id)
    if n is None:
        return None
    history = read_history(spark, history_base, run_id)
    n = history.filter(F.col("batch_id") <= n).agg(F.max("batch_id")).first()[0]
    if n is None:
        return None
    done = _snapshot_batches(spark, snapshot_base, run_id)
    if done and done[-1] >= n:
        # Nothing new. Never rewrite a snapshot folder: the merge reads it.
        return int(done[-1])
    base = _with_snapshot(spark, history.filter(F.col("batch_id") <= n), snapshot_base, run_id)
    group = ["run_id"] + list(key)
    values = [c for c in base.columns if c not in group and c != "batch_id"]
    snap = base.groupBy(*group).agg(*[F.max_by(c, "batch_id").alias(c) for c in values],
                                    F.max("batch_id").alias("batch_id"))
    (snap.drop("run_id").sortWithinPartitions("match_id", "player_equipo")
         .write.mode("overwrite").parquet(f"{snapshot_base}/run_id={run_id}/upto={n}"))
    return int(n)


Sink = Callable[[DataFrame, int], None]
Prepare = Callable[[DataFrame, int], DataFrame]


class MetricsBatchWriter:
    """``foreachBatch`` target running several sinks per epoch, on the rows as
    ``prepare`` returns them (a join with a table that may change, say).

    The epoch is persisted once and every sink writes from it. The sinks
    are independent Spark jobs, so they are submitted concurrently (Spark
    schedules jobs from several threads); every sink runs to the end and
    the epoch fails afterwards if any of them failed."""

    def __init__(self, sinks: Sequence[Sink], storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
                 concurrent: bool = True, prepare: Prepare | None = None):
        self.sinks = list(sinks)
        self.prepare = prepare
        self.storage_level = storage_level
        self.concurrent = concurrent

    def _run(self, sink: Sink, df: DataFrame, epoch_id: int) -> Exception | None:
        try:
            sink(df, epoch_id)
            return None
        except Exception as ex:  # noqa: BLE001 - re-raised by the caller
            return ex

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        if self.prepare is not None:
            df = self.prepare(df, epoch_id)
        df = df.persist(self.storage_level)
        try:
            if not df.count():  # fills the cache by all partitions at once
                return
            if self.concurrent and len(self.sinks) > 1:
                # InheritableThread carries the query's Spark job properties
                # (job group etc.), so stopping the query also cancels these jobs.
                results: list = [None] * len(self.sinks)

                def work(i: int, sink: Sink) -> None:
                    results[i] = self._run(sink, df, epoch_id)
                threads = [InheritableThread(target=work, args=(i, sink))
                           for i, sink in enumerate(self.sinks)]
                for t in threads:
                    t.start()
                for t in threads:
                    t.join()
            else:
                results = [self._run(s, df, epoch_id) for s in self.sinks]
            errors = [e for e in results if e is not None]
            if errors:
                raise RuntimeError(f"{len(errors)} sink(s) failed in epoch {epoch_id}") from errors[0]
        finally:
            df.unpersist()


def history_sink(base: str, run_id: str) -> Sink:
    return lambda df, epoch_id: write_history(df, base, run_id, epoch_id)


def bulk_sink(base: str, run_id: str, **kw) -> Sink:
    return lambda df, epoch_id: write_bulk_files(df, history_path(base, run_id, epoch_id), **kw)
