"""The latest-state table: one row per document id, as a search index holds it.

The metrics of an epoch have one row per player, name, team and position; a
player who changes position has two of them, but one document. An upsert keeps
the row that saw the latest event. The table has buckets of document ids, and a
bucket is a list of runs: an epoch writes its rows as a new run of the buckets
it has rows for, into a folder of its own, and then commits a log entry that
names the live runs of every bucket. When a bucket has ``RUNS`` runs of a level
(the newest among them), they are written as one run of the next level instead.
So a row is written once a level, and a table that takes in ever more epochs
writes rows in proportion to theirs, not the whole table each time; readers
merge the runs, keeping each document's latest row. Readers follow the newest
entry, so they see an epoch wholly or not at all; an epoch that is run again
after a failure overwrites its own folder, and one that is committed already is
left alone. Older entries stay readable until ``expire``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators.metrics import LAST_EVENT
from touchline.schemas import METRIC_KEYS
from touchline.streaming.files import Log, remove, subfolders

DOC_KEY = ["match_id", "player_id", "player_equipo"]
DOC_KEY_FAITHFUL = ["match_id", "player_id"]
#: Buckets of a new table; size them so that one bucket suits one task.
BUCKETS = 32
#: Runs of a level that become one of the next.
RUNS = 8


def runs_of(entry: dict) -> dict[int, list[list[int]]]:
    """[epoch, level] of the live runs of every bucket, oldest first."""
    # entries of a table whose buckets had one run each name its epoch only
    runs = entry.get("runs") or {b: [[v, 0]] for b, v in entry["live"].items()}
    return {int(b): own for b, own in runs.items()}


def with_run(own: list[list[int]], epoch: int) -> tuple[list[list[int]], list[list[int]]]:
    """(a bucket's runs after an epoch, the runs that the epoch's takes in)."""
    keep, level = len(own), 0
    while keep >= RUNS - 1 and all(x == level for _, x in own[keep - RUNS + 1:keep]):
        keep, level = keep - RUNS + 1, level + 1
    return own[:keep] + [[epoch, level]], own[keep:]


class DocumentTable:
    def __init__(self, spark: SparkSession, base: str, key: Sequence[str] = DOC_KEY, buckets: int = BUCKETS):
        self.spark, self.base, self.key = spark, base.rstrip("/"), list(key)
        self.log = Log(spark, f"{self.base}/_log")
        now = self.log.entry()
        # a table keeps the key and buckets it was made with
        self.buckets = now["buckets"] if now else buckets
        if now and now["key"] != self.key:
            raise ValueError(f"the table's key is {now['key']}")

    def _latest(self, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row a document: that of the latest event; of several rows at one
        time a fixed one, and of one row's versions the newest epoch's. ``by``
        names columns that the document id decides and that rows lie by."""
        rest = [c for c in METRIC_KEYS if c not in self.key]
        seen = F.col(LAST_EVENT) if LAST_EVENT in rows.columns else F.lit(None).cast("double")
        order = F.struct(seen, *rest, "batch_id")  # a null time counts as the earliest
        return rows.groupBy(*by, *self.key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")

    def _rows(self, entry: dict, runs: dict[int, list[list[int]]]) -> DataFrame | None:
        paths = [f"{self.base}/epoch={v}/bucket={b}" for b, own in sorted(runs.items()) for v, _ in own]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", self.base).schema(StructType.fromJson(entry["schema"]))
        return rows.parquet(*paths).drop("epoch", "bucket")

    def upsert(self, rows: DataFrame, epoch: int) -> None:
        now = self.log.entry() or {"epoch": -1, "live": {}}
        if now["epoch"] >= epoch:
            return
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")
        new = rows.withColumn("batch_id", F.lit(epoch).cast("bigint"))
        touched = sorted(r["bucket"] for r in new.select(bucket).distinct().collect())
        runs = runs_of(now)
        after = {b: with_run(runs.get(b, []), epoch) for b in touched}
        old = self._rows(now, {b: taken for b, (_, taken) in after.items()})
        # a later epoch may bring columns that earlier ones had not
        every = new if old is None else new.unionByName(old, allowMissingColumns=True)
        # one task a bucket, so an epoch writes at most one file for each
        (self._latest(every.select("*", bucket).repartition(len(touched) or 1, "bucket"), by=["bucket"])
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.base}/epoch={epoch}"))
        older = StructType.fromJson(now["schema"]).fields if "schema" in now else []
        schema = StructType(new.schema.fields + [f for f in older if f.name not in new.columns])
        runs |= {b: own for b, (own, _) in after.items()}
        self.log.commit(epoch, {"epoch": epoch, "key": self.key, "buckets": self.buckets,
                                "live": {str(b): own[-1][0] for b, own in runs.items()},
                                "runs": {str(b): own for b, own in runs.items()}, "schema": schema.jsonValue()})

    def read(self, epoch: int | None = None) -> DataFrame:
        """The documents as of an epoch, by default the newest."""
        entry = self.log.entry(epoch)
        runs = runs_of(entry) if entry else {}
        rows = self._rows(entry, runs)
        if rows is None:
            raise ValueError(f"{self.base} has no documents" + ("" if epoch is None else f" of epoch {epoch}"))
        return self._latest(rows) if any(len(own) > 1 for own in runs.values()) else rows

    def expire(self, keep: int = 1) -> list[int]:
        """Remove log entries but the newest ``keep`` (at least one), and epoch
        folders that no entry left refers to. Returns the removed epochs."""
        numbers = self.log.numbers()
        kept, dropped = numbers[-max(1, keep):], numbers[:-max(1, keep)]
        live = {v for n in kept for own in runs_of(self.log.entry(n)).values() for v, _ in own}
        for n in dropped:
            self.log.drop(n)
        gone = [v for v in sorted(int(x[len("epoch="):]) for x in subfolders(self.spark, self.base, "epoch="))
                if v not in live and kept and v <= kept[-1]]
        for v in gone:
            remove(self.spark, f"{self.base}/epoch={v}")
        return gone


def documents_sink(base: str, run_id: str, key: Sequence[str] = DOC_KEY, buckets: int = BUCKETS):
    """A sink of ``MetricsBatchWriter`` that upserts each epoch's rows."""
    def sink(df: DataFrame, epoch_id: int) -> None:
        DocumentTable(df.sparkSession, f"{base}/run_id={run_id}", key, buckets).upsert(df, epoch_id)
    return sink


def read_documents(spark: SparkSession, base: str, run_id: str, key: Sequence[str] = DOC_KEY) -> DataFrame:
    return DocumentTable(spark, f"{base}/run_id={run_id}", key).read()
