"""The streaming metrics job: source -> parse -> metrics -> sinks.

The transformation is exactly the batch one (``parse_events`` +
``player_metrics``); only the source and the sink differ. Aggregates are
order-independent (``max_by`` on event time, counts, sums), so late and
out-of-order events fold in correctly in any micro-batch.

Sources are injected: ``file_source`` (JSON-lines text files, used in tests
and for replays) and ``kafka_source`` (needs the spark-sql-kafka package on
the classpath; not available in this environment, so untested here).
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.metrics import player_metrics
from touchline.schemas import CYCLE_SECONDS
from touchline.session import shared_dir
from touchline.sources.events import parse_events, rejected_messages, replay_as, split_rejects
from touchline.streaming.documents import documents_sink
from touchline.streaming.sinks import MetricsBatchWriter, Prepare, Sink, bulk_sink, history_sink


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                latest_first: bool = False) -> DataFrame:
    """JSON-lines files as a stream of raw messages in column ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if latest_first:
        r = r.option("latestFirst", True)
    return r.load(path)


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", **options: str) -> DataFrame:
    """Kafka topic as a stream of raw messages (``value`` is binary).
    ``startingOffsets`` applies only when the checkpoint has no offsets."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    try:
        return r.load()
    except AnalysisException as ex:
        if "kafka" not in str(ex).lower():
            raise
        raise RuntimeError(
            "the Kafka connector is not on the classpath; submit with --packages "
            f"{kafka_package(spark)}") from ex


def kafka_package(spark: SparkSession) -> str:
    """Maven coordinate of the Kafka connector matching this Spark build."""
    scala = spark.sparkContext._jvm.scala.util.Properties.versionNumberString()
    return f"org.apache.spark:spark-sql-kafka-0-10_{'.'.join(scala.split('.')[:2])}:{spark.version}"


def metrics_from_messages(raw: DataFrame, faithful: bool = False,
                          cycle_seconds: float = CYCLE_SECONDS,
                          match_id: str | None = None, last_event: bool = False) -> DataFrame:
    """Raw messages -> player metrics. Default mode leaves out rows with no
    match or player (malformed messages); faithful mode keeps them as the
    original job does (they form one all-null group). ``match_id`` replays
    recorded messages as a new match; ``last_event`` keeps the time by which
    rows are merged into documents."""
    events = parse_events(raw)
    if not faithful:
        events, _ = split_rejects(events)
    if match_id is not None:
        events = replay_as(events, match_id)
    return player_metrics(events, cycle_seconds=cycle_seconds, last_event=last_event)


def new_run_id() -> str:
    """Sortable run id: a new match/run gets a new checkpoint and output
    folder; nothing is deleted."""
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"-{time.time_ns() % 1_000_000:06d}"


def start_metrics_query(raw: DataFrame, checkpoint: str, sinks: Sequence[Sink],
                        output_mode: str = "update", processing_time: str | None = "10 seconds",
                        available_now: bool = False, faithful: bool = False,
                        query_name: str | None = None,
                        match_id: str | None = None, last_event: bool = False,
                        prepare: Prepare | None = None) -> StreamingQuery:
    """Start the stateful metrics query with a ``foreachBatch`` writer.

    ``complete`` re-emits every group each epoch (the original); ``update``
    emits only groups changed in the epoch, which the merge-on-read latest
    view turns into the same final state."""
    metrics = metrics_from_messages(raw, faithful=faithful, match_id=match_id, last_event=last_event)
    w = (metrics.writeStream.outputMode(output_mode)
         .foreachBatch(MetricsBatchWriter(sinks, prepare=prepare))
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def start_rejects_query(raw: DataFrame, path: str, checkpoint: str,
                        processing_time: str | None = "10 seconds",
                        available_now: bool = False) -> StreamingQuery:
    """Append malformed / unattributable messages to JSON files (stateless,
    append mode, exactly-once through the file sink's own log)."""
    w = (rejected_messages(raw).writeStream.outputMode("append").format("json")
         .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def isolated_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A new session on the same SparkContext with the caller's runtime SQL
    settings plus ``conf`` overrides, so a replay can pick its own state
    partitioning and state store without changing the caller's session."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if s.conf.isModifiable(k):  # static settings are shared anyway
            s.conf.set(k, v)
    for k, v in conf.items():
        s.conf.set(k, v)
    return s


#: Aggregation state off the JVM heap, with only a changelog written per epoch.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def checkpoint_path(out_base: str, run_id: str) -> str:
    return f"{out_base}/checkpoints/{run_id}"


def run_replay(spark: SparkSession, events_path: str, out_base: str | None = None,
               run_id: str | None = None, output_mode: str = "update",
               max_files_per_trigger: int | None = 2, with_bulk: bool = True,
               state_partitions: int | None = None, with_documents: bool = False,
               rocksdb: bool = False, prepare: Prepare | None = None) -> tuple[str, str]:
    """Process every file under ``events_path`` with ``availableNow`` and
    return (history_base, run_id). Calling it again with the same
    ``out_base`` and ``run_id`` resumes from the checkpoint (which keeps the
    state partitioning and state store of its first run). ``state_partitions``
    and ``rocksdb`` run the query in an isolated session with those settings;
    ``with_documents`` adds the table of latest documents."""
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    conf.update(ROCKSDB if rocksdb else {})
    if conf:
        spark = isolated_session(spark, **conf)
    out_base = out_base or shared_dir(spark, "stream")
    run_id = run_id or new_run_id()
    history = f"{out_base}/history"
    sinks: list[Sink] = [history_sink(history, run_id)]
    if with_bulk:
        sinks.append(bulk_sink(f"{out_base}/bulk", run_id, now=None, compression="gzip"))
    if with_documents:
        sinks.append(documents_sink(f"{out_base}/documents", run_id))
    raw = file_source(spark, events_path, max_files_per_trigger)
    q = start_metrics_query(raw, checkpoint_path(out_base, run_id), sinks, output_mode=output_mode,
                            available_now=True, last_event=with_documents, prepare=prepare)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return history, run_id
