"""Registered queries for the publication side, the sinks and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.columns import iso_utc
from touchline.operators.metrics import METRIC_COLUMNS
from touchline.plans import dashboards as D
from touchline.schemas import METRIC_KEYS
from touchline.session import input_version, shared_dir
from touchline.sources.events import (adapted, encode_events, event_columns, events_from_table, parse_events,
                                      read_event_files, rejected_messages, table_rows)
from touchline.streaming.documents import read_documents
from touchline.streaming.files import order_slices
from touchline.streaming.job import checkpoint_path, metrics_from_messages, run_replay
from touchline.streaming.roster_versions import RosterVersions, join_roster
from touchline.streaming.sinks import (bulk_ndjson, compact_history, compact_latest, latest_from_history,
                                       read_bulk_files, read_history, read_last_epoch, read_latest)
from touchline.streaming.state import metrics_from_state

# Injected clock for the registered bulk query, so its output is
# reproducible; the sink itself stamps processing time.
BULK_CLOCK = "2024-02-01T00:00:00Z"
EVENT_FILES = 8
#: Rows of one event file: compressed files are read by one task each.
FILE_ROWS = 50_000
#: Parts of the published events that an epoch of a replay takes in.
PARTS = 2

_DONE: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, what: str, make):
    """What an application derives from ``sf_dir`` a single time: files it
    writes, replays it runs. Other input files make it anew."""
    key = (spark.sparkContext.applicationId, input_version(spark, sf_dir), what)
    if key not in _DONE:
        _DONE[key] = make()
    return _DONE[key]


def publish(rows: DataFrame, path: str, parts: int, change=lambda events: events) -> int:
    """Write the events of the table's ``rows`` as JSON-lines files in so many
    parts and return the files of a part. What is dealt out are the rows, which
    are far shorter than their messages."""
    files = max(1, rows.count() // (parts * FILE_ROWS))
    (encode_events(change(adapted(rows.repartition(parts * files)))).select("value")
     .write.mode("overwrite").text(path, compression="gzip"))
    return files


def published(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """(path, files of a part): the adapter events as JSON-lines files."""
    def write() -> tuple[str, int]:
        path = shared_dir(spark, "events-json")
        rows = table_rows(spark, sf_dir)
        # At least EVENT_FILES parts so the replay spans several epochs (more
        # when the input has more partitions). Round-robin spreads one
        # player's events over all files, so they arrive out of order.
        return path, publish(rows, path, max(EVENT_FILES, rows.rdd.getNumPartitions()))
    return once(spark, sf_dir, "events-json", write)


def event_files(spark: SparkSession, sf_dir: str) -> str:
    """Publish the adapter events as JSON-lines files (the replay input)."""
    return published(spark, sf_dir)[0]


def state_partitions(spark: SparkSession) -> int:
    """State partitions for the registered replays: the cluster's cores, so
    the state is spread over every executor without thousands of near-empty
    state stores per epoch on small inputs."""
    return max(1, spark.sparkContext.defaultParallelism)


def stream_run(spark: SparkSession, sf_dir: str, output_mode: str = "update") -> tuple[str, str]:
    """(history, run id) of a replay: in update mode with the document table,
    the bulk files and RocksDB state, as the job runs it."""
    update = output_mode == "update"
    path, files = published(spark, sf_dir)
    return once(spark, sf_dir, f"stream {output_mode}", lambda: run_replay(
        spark, path, output_mode=output_mode, max_files_per_trigger=PARTS * files, with_bulk=update,
        with_documents=update, rocksdb=update, state_partitions=state_partitions(spark)))


def _out(history: str) -> str:
    return history.rsplit("/", 1)[0]


def encoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_events(events_from_table(spark, sf_dir))


def events_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_event_files(spark, event_files(spark, sf_dir))


def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.plans.registry import metrics
    return bulk_ndjson(metrics(spark, sf_dir), now=BULK_CLOCK)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, run_id = stream_run(spark, sf_dir)
    latest = latest_from_history(read_history(spark, history, run_id))
    return latest.select(*METRIC_KEYS, *METRIC_COLUMNS)


def stream_latest_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original output mode: every group re-emitted each epoch, so the
    last committed epoch alone is the latest state."""
    history, run_id = stream_run(spark, sf_dir, "complete")
    latest = read_last_epoch(spark, history, run_id, checkpoint_path(_out(history), run_id))
    return latest.select(*METRIC_KEYS, *METRIC_COLUMNS)


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted latest state: a snapshot of the replayed run, read back
    merged with any later epochs (the upsert table of the original sink)."""
    history, run_id = stream_run(spark, sf_dir)
    snapshots = _out(history) + "/latest_snapshots"
    compact_latest(spark, history, snapshots, run_id)
    latest = read_latest(spark, history, snapshots, run_id)
    return latest.select(*METRIC_KEYS, *METRIC_COLUMNS)


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics as the replay's state store holds them after its last
    committed epoch, read from the checkpoint."""
    history, run_id = stream_run(spark, sf_dir)
    return metrics_from_state(spark, checkpoint_path(_out(history), run_id)).select(*METRIC_KEYS, *METRIC_COLUMNS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest-state table of the replay, one row per document id."""
    history, run_id = stream_run(spark, sf_dir)
    return read_documents(spark, _out(history) + "/documents", run_id)


def latest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).agg(F.count(F.lit(1)).alias("documentos"))


def _on_documents(fn, **kw):
    """A dashboard panel over the stream's output, as the panels are used."""
    return lambda spark, sf_dir: fn(documents(spark, sf_dir).select(*METRIC_KEYS, *METRIC_COLUMNS), **kw)


def bulk_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that a search engine holds after taking in every bulk
    file of the replay, epoch by epoch."""
    history, run_id = stream_run(spark, sf_dir)
    docs = read_bulk_files(spark, _out(history) + "/bulk", run_id, documents(spark, sf_dir).schema)
    return latest_from_history(docs).select(*METRIC_KEYS, *METRIC_COLUMNS)


def second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the job into one folder, the second with every second event:
    its state and history are its own."""
    def run() -> tuple[str, str]:
        base = shared_dir(spark, "two-runs")
        for k in (0, 1):
            rows = table_rows(spark, sf_dir).filter(F.pmod(F.col("event_id"), F.lit(2)) == k)
            files = publish(rows, f"{base}/events{k}", 2)
            out = run_replay(spark, f"{base}/events{k}", out_base=f"{base}/out", run_id=f"run{k}", with_bulk=False,
                             max_files_per_trigger=PARTS * files, state_partitions=state_partitions(spark))
        return out
    history, run_id = once(spark, sf_dir, "two runs", run)
    return latest_from_history(read_history(spark, history, run_id)).select(*METRIC_KEYS, *METRIC_COLUMNS)


def replayed_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded messages of all matches replayed as one new match."""
    raw = encode_events(events_from_table(spark, sf_dir)).select("value")
    return metrics_from_messages(raw, match_id="M-nuevo").select(*METRIC_KEYS, *METRIC_COLUMNS)


def event_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' times as the documents write theirs, from a kick-off at the
    injected clock."""
    start = F.to_timestamp(F.lit(BULK_CLOCK))
    at = F.timestamp_seconds(F.unix_timestamp(start) + F.col("timestamp"))
    return events_from_table(spark, sf_dir).select("match_id", "event_id", iso_utc(at).alias("reloj"))


# Match time from which the replay of changing positions has every second
# player as a forward.
POSITION_CHANGE = 302400.0


def position_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a replay in which players change position during a match:
    two metrics rows each, one document, that of the later position."""
    def run() -> tuple[str, str]:
        path = shared_dir(spark, "events-moved")
        moved = (F.col("timestamp") >= POSITION_CHANGE) & (F.col("player_equipo") == "A")
        posicion = F.when(moved, F.lit("ST")).otherwise(F.col("player_posicion"))
        files = publish(table_rows(spark, sf_dir), path, EVENT_FILES, lambda ev: ev.withColumn("player_posicion", posicion))
        return run_replay(spark, path, max_files_per_trigger=PARTS * files, with_bulk=False, with_documents=True,
                          state_partitions=state_partitions(spark))
    history, run_id = once(spark, sf_dir, "position changes", run)
    return read_documents(spark, _out(history) + "/documents", run_id).select(*METRIC_KEYS, *METRIC_COLUMNS)


EVOLUTION_SLICES = 8


def slice_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """(path, files of each slice): the events in EVOLUTION_SLICES slices by
    event id, every slice in as many files, in one write; the files' times put
    the slices in order."""
    def write() -> tuple[str, int]:
        rows = table_rows(spark, sf_dir)
        files = max(1, rows.count() // (EVOLUTION_SLICES * FILE_ROWS))
        while True:
            path = shared_dir(spark, "evolution-in")
            cut = rows.withColumn("slice", F.pmod(F.col("event_id"), F.lit(EVOLUTION_SLICES))).withColumn(
                "part", F.pmod(F.floor(F.col("event_id") / EVOLUTION_SLICES), F.lit(files)))
            # the table's rows are dealt out and put in order, not their messages
            dealt = cut.repartition(4 * EVOLUTION_SLICES * files, "slice", "part").sortWithinPartitions("slice", "part")
            (encode_events(adapted(dealt, keep=("slice", "part")), keep=("slice", "part")).select("value", "slice", "part")
             .write.partitionBy("slice", "part").text(path, compression="gzip"))
            if order_slices(spark, path, "slice=") == {files} or files == 1:
                return path, files
            files = 1  # ids with gaps: some part of a slice has no rows
    return once(spark, sf_dir, "slices", write)


def evolution_run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """One replay with deterministic epochs: epoch i holds exactly slice i."""
    path, files = slice_files(spark, sf_dir)
    return once(spark, sf_dir, "evolution", lambda: run_replay(
        spark, f"{path}/*/*", run_id="evolution", max_files_per_trigger=files, with_bulk=False,
        state_partitions=state_partitions(spark)))


def metric_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of goals, distance and stamina between consecutive epochs of
    each player's metrics row in the stream history (update mode: a row
    appears in the epochs in which it changed). A window per key holds at
    most one row per epoch."""
    history, run_id = evolution_run(spark, sf_dir)
    h = read_history(spark, history, run_id)
    w = Window.partitionBy(*METRIC_KEYS).orderBy("batch_id")
    return h.select(
        *METRIC_KEYS, F.col("batch_id").cast("bigint").alias("batch_id"), "goles",
        "distancia_m", "estamina_actual",
        (F.col("goles") - F.coalesce(F.lag("goles").over(w), F.lit(0))).alias("delta_goles"),
        (F.col("distancia_m") - F.lag("distancia_m").over(w)).alias("delta_distancia"),
        (F.col("estamina_actual") - F.lag("estamina_actual").over(w)).alias("delta_estamina"))


# The epoch before which the roster of the registered replay is replaced.
ROSTER_CHANGE = 4


def roster_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of the stream joined with the roster of their time: before epoch
    ROSTER_CHANGE a new version is published, with one more point of pace."""
    from touchline.plans.registry_roster import clean

    def run() -> tuple[str, str]:
        out = shared_dir(spark, "stream-roster")
        versions = RosterVersions(spark, f"{out}/rosters")
        roster = clean(spark, sf_dir)
        versions.publish(roster)
        join = join_roster(f"{out}/rosters", f"{out}/roster_epochs")

        def prepare(df: DataFrame, epoch: int) -> DataFrame:
            if epoch == ROSTER_CHANGE and versions.current() == 0:
                versions.publish(roster.withColumn("velocidad", F.col("velocidad") + 1))
            return join(df, epoch)
        path, files = slice_files(spark, sf_dir)
        return run_replay(spark, f"{path}/*/*", out_base=out, run_id="roster", max_files_per_trigger=files,
                          with_bulk=False, state_partitions=state_partitions(spark), prepare=prepare)
    history, run_id = once(spark, sf_dir, "roster in stream", run)
    h = read_history(spark, history, run_id)
    return h.select(*METRIC_KEYS, F.col("batch_id").cast("bigint").alias("batch_id"), "goles", "distancia_m",
                    "genero", "velocidad", "resistencia", "version_plantilla")


def history_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evolution's history after compaction: rows and players by epoch."""
    history, run_id = evolution_run(spark, sf_dir)
    compact_history(spark, history, run_id)
    h = read_history(spark, history, run_id)
    return h.groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum("goles").alias("goles"))


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that no player's metrics can hold, and why: of the published
    events every 50th is cut off, every 70th has no player and every 110th no
    match."""
    n = F.col("event_id")
    ev = events_from_table(spark, sf_dir)
    ev = (ev.withColumn("player_id", F.when(n % 70 == 0, F.lit(None)).otherwise(F.col("player_id")))
          .withColumn("match_id", F.when(n % 110 == 0, F.lit(None)).otherwise(F.col("match_id")).cast("string")))
    raw = encode_events(ev, keep=("event_id",)).select(
        F.when(n % 50 == 0, F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value"))
    return rejected_messages(raw).groupBy("motivo").agg(
        F.count(F.lit(1)).alias("mensajes"), F.sum(F.length("mensaje")).alias("caracteres"))


def encoded_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication with two decimals and without the event id, as the original
    producer sends it, read back."""
    ev = events_from_table(spark, sf_dir)
    third = ev.withColumns({c: F.col(c) / 3 for c in ("x", "y", "estamina")})
    raw = encode_events(third, include_tiebreak=False, round_digits=2, keep=("event_id",))
    back = parse_events(raw.select("value")).select(event_columns(with_tiebreak=False))
    return back.groupBy("match_id", "tipo").agg(
        F.count(F.lit(1)).alias("eventos"),
        *[F.sum(F.round(F.col(c) * 100).cast("bigint")).alias(f"{c}_centesimas") for c in ("x", "y", "estamina", "ball_x", "speed_jugador")])


STREAM_QUERIES = {
    "encode_events": encoded_events,
    "events_roundtrip": events_roundtrip,
    "bulk_ndjson": bulk,
    "stream_metrics": stream_latest,
    "stream_metrics_complete": stream_latest_complete,
    "latest_snapshot": latest_snapshot,
    "latest_count": latest_count,
    "bulk_readback": bulk_readback,
    "second_run": second_run,
    "replayed_match": replayed_match,
    "event_clock": event_clock,
    "stream_state": stream_state,
    "position_changes": position_changes,
    "live_match_kpis": _on_documents(D.match_kpis),
    "live_top_scorers": _on_documents(D.top_scorers),
    "live_team_stamina": _on_documents(D.team_stamina),
    "metric_evolution": metric_evolution,
    "history_compacted": history_compacted,
    "roster_in_stream": roster_in_stream,
    "event_rejects": event_rejects,
    "encoded_rounded": encoded_rounded,
}
