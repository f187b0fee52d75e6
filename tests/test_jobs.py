"""The two submitted jobs, end to end on the test tables."""

from pyspark.sql import functions as F

from helpers import SF_SMALL
from touchline.jobs import roster_job, stream_job
from touchline.operators.metrics import METRIC_COLUMNS, player_metrics
from touchline.schemas import METRIC_KEYS
from touchline.sources.events import encode_events, events_from_table
from touchline.sources.roster import write_roster_csvs
from touchline.streaming.sinks import (latest_from_history, read_foreign_history, read_history,
                                       write_history)


def test_roster_job_both_read_modes(spark, tmp_out):
    men, women = write_roster_csvs(spark, SF_SMALL, f"{tmp_out}/csv")
    n1 = roster_job(spark, men, women, f"{tmp_out}/p1", infer_schema=True)
    n2 = roster_job(spark, men, women, f"{tmp_out}/p2", infer_schema=False)
    a = spark.read.parquet(f"{tmp_out}/p1")
    b = spark.read.parquet(f"{tmp_out}/p2")
    assert n1 == n2 == a.count() > 0
    assert a.schema == b.schema
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_stream_job_files_rocksdb_and_roster(spark, tmp_out):
    ev = events_from_table(spark, SF_SMALL)
    encode_events(ev).select("value").repartition(3).write.text(f"{tmp_out}/in")
    men, women = write_roster_csvs(spark, SF_SMALL, f"{tmp_out}/csv")
    roster_job(spark, men, women, f"{tmp_out}/roster")
    try:
        stream_job(spark, f"{tmp_out}/out", files=f"{tmp_out}/in", run_id="r9",
                   available_now=True, roster=f"{tmp_out}/roster")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    latest = latest_from_history(read_history(spark, f"{tmp_out}/out/history", "r9"))
    cols = METRIC_KEYS + METRIC_COLUMNS
    assert (sorted(map(tuple, latest.select(*cols).collect()))
            == sorted(map(tuple, player_metrics(ev).select(*cols).collect())))
    enriched = read_history(spark, f"{tmp_out}/out/history_roster", "r9")
    assert "velocidad" in enriched.columns and enriched.filter(F.col("velocidad").isNotNull()).count() > 0
    bulk = spark.read.text(f"{tmp_out}/out/bulk")
    assert bulk.count() == 2 * read_history(spark, f"{tmp_out}/out/history", "r9").count()


def test_foreign_history_layout(spark, tmp_out):
    df = player_metrics(events_from_table(spark, SF_SMALL))
    for b in (0, 3):
        df.write.parquet(f"{tmp_out}/legacy/batch_{b}")
    h = read_foreign_history(spark, f"{tmp_out}/legacy")
    assert sorted(r.batch_id for r in h.select("batch_id").distinct().collect()) == [0, 3]
    write_history(df, f"{tmp_out}/new", "r", 1)
    assert read_history(spark, f"{tmp_out}/new").select("run_id").distinct().collect()[0].run_id == "r"


def test_stream_job_writes_rejects(spark, tmp_out):
    good = encode_events(events_from_table(spark, SF_SMALL).limit(50)).select("value")
    bad = spark.createDataFrame([("not json",), ('{"match_id":"m"}',), ("{}",)], "value string")
    good.union(bad).repartition(2).write.text(f"{tmp_out}/in")
    stream_job(spark, f"{tmp_out}/out", files=f"{tmp_out}/in", run_id="rj",
               available_now=True, rocksdb=False)
    rej = spark.read.json(f"{tmp_out}/out/rejects/run_id=rj")
    got = sorted((r.mensaje, r.motivo) for r in rej.collect())
    assert got == [('not json', 'sin_datos'), ('{"match_id":"m"}', 'sin_player_id'),
                   ('{}', 'sin_datos')]
    h = read_history(spark, f"{tmp_out}/out/history", "rj")
    assert h.filter(F.col("match_id").isNull()).count() == 0


def test_replay_as_new_match(spark):
    from touchline.sources.events import replay_as
    ev = replay_as(events_from_table(spark, SF_SMALL), "M-new")
    assert [r.match_id for r in player_metrics(ev).select("match_id").distinct().collect()] == ["M-new"]


def test_stream_faithful_mode_keeps_null_group(spark, tmp_out):
    bad = spark.createDataFrame([("not json",), ("{}",)], "value string")
    good = encode_events(events_from_table(spark, SF_SMALL).limit(20)).select("value")
    good.union(bad).repartition(1).write.text(f"{tmp_out}/in")
    stream_job(spark, f"{tmp_out}/out", files=f"{tmp_out}/in", run_id="f",
               available_now=True, rocksdb=False, faithful=True)
    h = latest_from_history(read_history(spark, f"{tmp_out}/out/history", "f"))
    nulls = h.filter(F.col("match_id").isNull()).collect()
    assert len(nulls) == 1 and nulls[0].eventos_zona_ataque == 2


def test_jobs_script_entry_point(tmp_out):
    import subprocess
    import sys
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, os.path.join(root, "touchline", "jobs.py"), "--help"],
                       capture_output=True, text=True, timeout=60)
    assert r.returncode == 0 and "roster" in r.stdout and "stream" in r.stdout


def test_stream_job_replays_as_new_match(spark, tmp_out):
    encode_events(events_from_table(spark, SF_SMALL)).select("value").write.text(f"{tmp_out}/in")
    stream_job(spark, f"{tmp_out}/out", files=f"{tmp_out}/in", run_id="m", available_now=True,
               rocksdb=False, match_id="replay-1")
    h = read_history(spark, f"{tmp_out}/out/history", "m")
    assert [r.match_id for r in h.select("match_id").distinct().collect()] == ["replay-1"]


def test_supervise_stops_siblings_when_one_query_fails(spark, tmp_out):
    import pytest
    from touchline.jobs import supervise
    ok = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    good = ok.writeStream.format("noop").start()

    def boom(df, epoch_id):
        raise ValueError("sink down")
    bad = ok.writeStream.foreachBatch(boom).option(
        "checkpointLocation", f"{tmp_out}/ckpt").start()
    with pytest.raises(RuntimeError, match="sink down"):
        supervise([good, bad], wait_for_all=False)
    assert not good.isActive and not bad.isActive


def test_batch_metrics_job_equals_stream_transformation(spark, tmp_out):
    from touchline.jobs import metrics_job
    ev = events_from_table(spark, SF_SMALL)
    bad = spark.createDataFrame([("not json",)], "value string")
    encode_events(ev).select("value").union(bad).write.text(f"{tmp_out}/in")
    metrics_job(spark, f"{tmp_out}/in", f"{tmp_out}/m", rejects=f"{tmp_out}/rej")
    cols = METRIC_KEYS + METRIC_COLUMNS
    got = spark.read.parquet(f"{tmp_out}/m").select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, player_metrics(ev).select(*cols).collect()))
    assert spark.read.json(f"{tmp_out}/rej").count() == 1


def test_published_rosters_documents_and_compaction(spark, tmp_out):
    from touchline.jobs import compact_job
    from touchline.streaming.documents import read_documents
    from touchline.streaming.files import subfolders
    ev = events_from_table(spark, SF_SMALL)
    encode_events(ev).select("value").repartition(3).write.text(f"{tmp_out}/in")
    men, women = write_roster_csvs(spark, SF_SMALL, f"{tmp_out}/csv")
    assert [roster_job(spark, men, women, f"{tmp_out}/rosters", publish=True) for _ in range(2)] == [0, 1]
    out = f"{tmp_out}/out"
    stream_job(spark, out, files=f"{tmp_out}/in", run_id="v", available_now=True, rocksdb=False, roster=f"{tmp_out}/rosters")
    h = read_history(spark, f"{out}/history", "v")
    assert [r.version_plantilla for r in h.select("version_plantilla").distinct().collect()] == [1]
    assert h.filter(F.col("velocidad").isNotNull()).count() > 0
    cols = METRIC_KEYS + METRIC_COLUMNS
    want = sorted(map(tuple, player_metrics(ev).select(*cols).collect()))
    docs = read_documents(spark, f"{out}/documents", "v")
    assert sorted(map(tuple, docs.select(*cols).collect())) == want and "media" in docs.columns
    before = sorted(map(tuple, h.select(*cols, "batch_id").collect()))
    upto = compact_job(spark, out, "v", expire=True)
    assert upto == max(r[-1] for r in before) and subfolders(spark, f"{out}/history/run_id=v") == []
    assert sorted(map(tuple, read_history(spark, f"{out}/history", "v").select(*cols, "batch_id").collect())) == before
    # the run goes on after its epochs were merged away
    encode_events(ev.limit(30)).select("value").write.mode("append").text(f"{tmp_out}/in")
    stream_job(spark, out, files=f"{tmp_out}/in", run_id="v", available_now=True, rocksdb=False, roster=f"{tmp_out}/rosters")
    again = read_history(spark, f"{out}/history", "v")
    assert again.count() > len(before) and again.agg(F.max("batch_id")).first()[0] > upto


def test_foreign_roster_folder_is_joined_apart(spark, tmp_out):
    """A plain roster, without versions, still makes the second history."""
    encode_events(events_from_table(spark, SF_SMALL)).select("value").coalesce(1).write.text(f"{tmp_out}/in")
    men, women = write_roster_csvs(spark, SF_SMALL, f"{tmp_out}/csv")
    roster_job(spark, men, women, f"{tmp_out}/plain")
    stream_job(spark, f"{tmp_out}/out", files=f"{tmp_out}/in", run_id="p", available_now=True, rocksdb=False, roster=f"{tmp_out}/plain")
    assert "velocidad" not in read_history(spark, f"{tmp_out}/out/history", "p").columns
    assert "velocidad" in read_history(spark, f"{tmp_out}/out/history_roster", "p").columns
