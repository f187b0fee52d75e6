"""Command-line jobs: the programs a user submits (roster ETL, streaming
metrics, batch metrics recompute).

    zip -r touchline.zip touchline          # ship the package to executors
    spark-submit --py-files touchline.zip touchline/jobs.py roster \
        --men M.csv --women W.csv --out /shared/players_parquet
    spark-submit --py-files touchline.zip touchline/jobs.py stream \
        --kafka host:9092 --topic football_events --out /shared/metrics [--run-id R]
    spark-submit --py-files touchline.zip touchline/jobs.py stream \
        --files /shared/events_json --available-now --out /shared/metrics
    spark-submit --py-files touchline.zip touchline/jobs.py metrics \
        --events /shared/events_json --out /shared/metrics_batch

Locally, ``python -m touchline.jobs ...`` or the ``touchline`` command after
``pip install .`` does the same. All read the cluster's session
configuration; nothing here sets executor sizes or partition counts.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script: put the package's parent on the path
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from touchline.operators.roster import clean_roster, union_rosters
from touchline.sources.roster import read_roster_csv, write_roster_parquet
from touchline.streaming.documents import documents_sink
from touchline.streaming.job import (ROCKSDB, checkpoint_path, file_source, kafka_source, new_run_id,
                                     start_metrics_query, start_rejects_query)
from touchline.streaming.roster_versions import RosterVersions, join_roster
from touchline.streaming.sinks import (Prepare, Sink, bulk_sink, compact_history, expire_epochs,
                                       history_sink)


def roster_job(spark: SparkSession, men: str, women: str, out: str,
               infer_schema: bool = False, publish: bool = False) -> int:
    """Two player CSVs -> one clean Parquet roster; returns rows written. With
    ``publish`` it becomes the next version of the rosters in ``out``, which a
    running stream takes up, and the version's number is returned."""
    raw = union_rosters(read_roster_csv(spark, men, infer_schema),
                        read_roster_csv(spark, women, infer_schema))
    if publish:
        return RosterVersions(spark, out).publish(clean_roster(raw))
    return write_roster_parquet(clean_roster(raw), out)


def compact_job(spark: SparkSession, out: str, run_id: str, expire: bool = False) -> int | None:
    """Merge the finished epochs of a run's history into few files; with
    ``expire`` remove the epoch folders they replace."""
    upto = compact_history(spark, f"{out}/history", run_id)
    if expire:
        expire_epochs(spark, f"{out}/history", run_id)
    return upto


def metrics_job(spark: SparkSession, events: str, out: str, faithful: bool = False,
                rejects: str | None = None) -> None:
    """Batch recomputation of the player metrics from archived JSON-lines
    event files, with the same transformation as the stream. Output is
    Parquet clustered by match inside each file; unattributable messages go
    to ``rejects`` when given."""
    from touchline.operators.metrics import player_metrics
    from touchline.sources.events import parse_events, rejected_messages, split_rejects

    raw = spark.read.text(events)
    parsed = parse_events(raw)
    if not faithful:
        parsed, _ = split_rejects(parsed)
        if rejects:
            rejected_messages(raw).write.mode("overwrite").json(rejects)
    (player_metrics(parsed).sortWithinPartitions("match_id", "player_equipo")
     .write.mode("overwrite").parquet(out))


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming aggregation state off the JVM heap, and commit only a
    changelog per epoch instead of uploading a full snapshot (set before the
    query first starts; the provider is fixed by the checkpoint)."""
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)


def roster_enrichment_sink(base: str, run_id: str, roster: DataFrame) -> Sink:
    """History of metrics joined to roster attributes, per epoch (the
    join runs on the epoch's batch DataFrame, so any join type is allowed)."""
    from touchline.operators.joins import metrics_with_roster
    from touchline.streaming.sinks import write_history

    def sink(df: DataFrame, epoch_id: int) -> None:
        write_history(metrics_with_roster(df, roster), base, run_id, epoch_id)
    return sink


def stream_job(spark: SparkSession, out: str, kafka: str | None = None, topic: str | None = None,
               files: str | None = None, run_id: str | None = None, mode: str = "update",
               available_now: bool = False, trigger: str = "10 seconds",
               starting_offsets: str = "latest", rocksdb: bool = True,
               roster: str | None = None, faithful: bool = False,
               max_offsets_per_trigger: int | None = None,
               match_id: str | None = None, state_partitions: int | None = None) -> None:
    if rocksdb:
        use_rocksdb_state(spark)
    if state_partitions:
        # The number of state partitions is the shuffle partition count at the
        # query's first start; the checkpoint keeps it for every restart.
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    run_id = run_id or new_run_id()
    if kafka:
        opts = ({"maxOffsetsPerTrigger": str(max_offsets_per_trigger)}
                if max_offsets_per_trigger else {})
        raw = kafka_source(spark, kafka, topic or "football_events", starting_offsets, **opts)
    elif files:
        raw = file_source(spark, files)
    else:
        raise ValueError("give --kafka or --files")
    sinks: list[Sink] = [history_sink(f"{out}/history", run_id), bulk_sink(f"{out}/bulk", run_id),
                         documents_sink(f"{out}/documents", run_id)]
    prepare: Prepare | None = None
    if roster and RosterVersions(spark, roster).current() is None:  # one roster, as the batch job writes it
        sinks.append(roster_enrichment_sink(f"{out}/history_roster", run_id, spark.read.parquet(roster)))
    elif roster:
        # the versions are read as epochs come: one published while the query
        # runs (``roster --publish``) counts from the next epoch on
        prepare = join_roster(roster, f"{out}/roster_epochs/run_id={run_id}")
    q = start_metrics_query(raw, checkpoint_path(out, run_id), sinks, output_mode=mode,
                            processing_time=trigger, available_now=available_now,
                            faithful=faithful, match_id=match_id, last_event=True, prepare=prepare)
    queries = [q]
    if not faithful:
        queries.append(start_rejects_query(raw, f"{out}/rejects/run_id={run_id}",
                                           f"{out}/checkpoints/{run_id}-rejects",
                                           processing_time=trigger, available_now=available_now))
    print(f"run_id={run_id}")
    supervise(queries, wait_for_all=available_now)


def supervise(queries: list, wait_for_all: bool) -> None:
    """Block until the job ends. ``availableNow`` runs end on their own, so
    wait for all of them; a continuous job ends only on failure or stop, so
    the first query to terminate stops the others and its error is raised."""
    try:
        if wait_for_all:
            for q in queries:
                q.awaitTermination()
        else:
            # Poll our own queries: the session-wide awaitAnyTermination also
            # returns for queries that ended earlier in the same session.
            while all(q.isActive for q in queries):
                try:
                    queries[0].awaitTermination(5)
                except Exception:  # noqa: BLE001 - reported below with the query's own error
                    break
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    failed = [q for q in queries if q.exception() is not None]
    if failed:
        raise RuntimeError(str(failed[0].exception()))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="touchline.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("roster")
    r.add_argument("--men", required=True)
    r.add_argument("--women", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--infer-schema", action="store_true")
    r.add_argument("--publish", action="store_true", help="as the next version of the rosters in --out")
    c = sub.add_parser("compact", help="merge a run's finished epochs into few files")
    c.add_argument("--out", required=True)
    c.add_argument("--run-id", required=True)
    c.add_argument("--expire", action="store_true", help="remove the epoch folders they replace")
    b = sub.add_parser("metrics", help="batch metrics from archived JSON-lines events")
    b.add_argument("--events", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--rejects")
    b.add_argument("--faithful", action="store_true")
    s = sub.add_parser("stream")
    s.add_argument("--out", required=True)
    s.add_argument("--kafka")
    s.add_argument("--topic", default="football_events")
    s.add_argument("--files")
    s.add_argument("--run-id")
    s.add_argument("--mode", choices=["update", "complete"], default="update")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--trigger", default="10 seconds")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--roster", help="a roster to join in a second history, or a folder of published versions to join before the sinks")
    s.add_argument("--faithful", action="store_true")
    s.add_argument("--no-rocksdb", action="store_true")
    s.add_argument("--match-id", help="replay the messages as this match")
    s.add_argument("--state-partitions", type=int,
                   help="state store partitions, fixed at the first start of a checkpoint "
                        "(size so one partition's state fits an executor comfortably)")
    s.add_argument("--max-offsets-per-trigger", type=int,
                   help="cap records per epoch (Kafka) so a backlog is drained in bounded epochs")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"touchline-{a.cmd}").getOrCreate()
    if a.cmd == "roster":
        n = roster_job(spark, a.men, a.women, a.out, a.infer_schema, a.publish)
        print(f"published version {n} in {a.out}" if a.publish else f"wrote {n} players to {a.out}")
    elif a.cmd == "compact":
        print(f"merged up to epoch {compact_job(spark, a.out, a.run_id, a.expire)}")
    elif a.cmd == "metrics":
        metrics_job(spark, a.events, a.out, a.faithful, a.rejects)
    else:
        stream_job(spark, a.out, a.kafka, a.topic, a.files, a.run_id, a.mode, a.available_now,
                   a.trigger, a.starting_offsets, not a.no_rocksdb, a.roster, a.faithful,
                   a.max_offsets_per_trigger, a.match_id, a.state_partitions)
    return 0


if __name__ == "__main__":
    sys.exit(main())

