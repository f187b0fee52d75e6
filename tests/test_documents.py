"""The document table, history compaction, committed epochs, state read-back
and roster versions."""

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, events_df
from touchline.operators.metrics import METRIC_COLUMNS, player_metrics
from touchline.schemas import METRIC_KEYS
from touchline.sources.events import encode_events, events_from_table
from touchline.streaming import sinks
from touchline.streaming.documents import DOC_KEY_FAITHFUL, DocumentTable, read_documents
from touchline.streaming.files import Log, commit_text, read_text, subfolders
from touchline.streaming.job import checkpoint_path, run_replay
from touchline.streaming.roster_versions import RosterVersions, join_roster
from touchline.streaming.state import metrics_from_state, read_state

COLS = METRIC_KEYS + METRIC_COLUMNS


def _rows(df, cols=COLS):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _metrics(spark, rows):
    return player_metrics(events_df(spark, rows), last_event=True)


def test_position_change_is_one_document(spark, tmp_out):
    cm = [{"timestamp": 2.0, "x": 10.0}, {"timestamp": 4.0, "x": 11.0}]
    st = [{"timestamp": 6.0, "x": 90.0, "player_posicion": "ST"}]
    both = _metrics(spark, cm + st)
    assert both.count() == 2
    table = DocumentTable(spark, f"{tmp_out}/d", buckets=4)
    table.upsert(_metrics(spark, cm), 0)
    table.upsert(both, 1)
    doc = table.read().collect()
    assert len(doc) == 1 and (doc[0].player_posicion, doc[0].ultima_x, doc[0].batch_id) == ("ST", 90.0, 1)
    # a late event of the old position does not take the document back, one
    # after the change does
    table.upsert(_metrics(spark, cm + [{"timestamp": 5.0, "x": 12.0}]), 2)
    assert table.read().collect()[0].player_posicion == "ST"
    table.upsert(_metrics(spark, cm + [{"timestamp": 8.0, "x": 12.0}]), 3)
    assert table.read().collect()[0].player_posicion == "CM" and table.read(1).collect()[0].player_posicion == "ST"


def test_upsert_rewrites_touched_buckets_only_and_switches_once(spark, tmp_out):
    people = [{"player_id": str(i), "player_nombre": f"P{i}"} for i in range(60)]
    table = DocumentTable(spark, f"{tmp_out}/d", buckets=16)
    table.upsert(_metrics(spark, people), 0)
    table.upsert(_metrics(spark, [{**people[7], "timestamp": 9.0}]), 5)
    entry = table.log.entry()
    assert sorted(set(entry["live"].values())) == [0, 5] and list(entry["live"].values()).count(5) == 1
    assert table.read().count() == 60
    # an epoch that failed before its entry is invisible, and is written anew
    rows = _metrics(spark, people[:3] + [{"player_id": "new"}]).withColumn("batch_id", F.lit(6).cast("bigint"))
    rows.withColumn("bucket", F.lit(3)).write.partitionBy("bucket").parquet(f"{tmp_out}/d/epoch=6")
    assert table.read().count() == 60
    table.upsert(rows.drop("batch_id"), 6)
    assert table.read().count() == 61
    before = _rows(table.read())
    table.upsert(_metrics(spark, [{"player_id": "later"}]), 6)  # committed already: left alone
    assert _rows(table.read()) == before
    assert DocumentTable(spark, f"{tmp_out}/d", buckets=99).buckets == 16
    with pytest.raises(ValueError):
        DocumentTable(spark, f"{tmp_out}/d", key=DOC_KEY_FAITHFUL)
    assert table.log.numbers() == [0, 5, 6]
    table.expire(keep=1)
    assert table.log.numbers() == [6] and _rows(table.read()) == before
    with pytest.raises(ValueError):
        table.read(0)


def test_null_ids_are_documents_too(spark, tmp_out):
    table = DocumentTable(spark, f"{tmp_out}/d")
    rows = [{"player_id": None}, {"match_id": None}, {"player_id": None, "timestamp": None, "player_posicion": "GK"}]
    table.upsert(_metrics(spark, rows), 0)
    table.upsert(_metrics(spark, rows), 1)
    got = {(r.match_id, r.player_id): r.player_posicion for r in table.read().collect()}
    assert got == {("m1", None): "CM", (None, "7"): "CM"}
    with pytest.raises(ValueError):
        DocumentTable(spark, f"{tmp_out}/none").read()


def test_later_epochs_may_bring_columns(spark, tmp_out):
    table = DocumentTable(spark, f"{tmp_out}/d", buckets=8)
    table.upsert(_metrics(spark, [{"player_id": str(i)} for i in range(20)]), 0)
    table.upsert(_metrics(spark, [{"player_id": "3", "timestamp": 9.0}]).withColumn("media", F.lit("80")), 1)
    got = {r.player_id: r.media for r in table.read().collect()}
    assert len(got) == 20 and got["3"] == "80" and got["4"] is None


def test_stream_documents_equal_batch(spark, tmp_out):
    ev = events_from_table(spark, SF_SMALL)
    encode_events(ev).select("value").repartition(4).write.text(f"{tmp_out}/in")
    run_replay(spark, f"{tmp_out}/in", out_base=f"{tmp_out}/o", run_id="r", max_files_per_trigger=1, with_bulk=False, with_documents=True)
    assert _rows(read_documents(spark, f"{tmp_out}/o/documents", "r")) == _rows(player_metrics(ev))


def test_log_entries(spark, tmp_out):
    log = Log(spark, f"{tmp_out}/log")
    assert log.entry() is None and log.numbers() == []
    log.commit(3, {"a": 1})
    log.commit(12, {"a": "é"})
    assert log.numbers() == [3, 12] and log.entry() == {"a": "é"} and log.entry(3) == {"a": 1} and log.entry(4) is None
    commit_text(spark, f"{tmp_out}/t.txt", "x\ny")
    assert read_text(spark, f"{tmp_out}/t.txt") == "x\ny"


def _epoch(spark, n, goals):
    cols = "match_id string, player_id string, player_nombre string, player_equipo string, player_posicion string, goles long"
    return spark.createDataFrame([("m", str(i), "n", "A", "CM", g) for i, g in enumerate(goals)], cols).repartition(n)


def test_files_of_an_epoch_follow_its_rows(spark, tmp_out):
    for shuffles, base in ((2, "a"), (40, "b")):
        sinks.write_history(_epoch(spark, shuffles, range(100)), f"{tmp_out}/{base}", "r", 0, rows_per_file=30)
    files = [len([f for f in spark.read.parquet(f"{tmp_out}/{b}").inputFiles()]) for b in "ab"]
    assert files == [2, 4]  # never more partitions than there are


def test_compaction_switches_readers_and_spares_old_ones(spark, tmp_out):
    base = f"{tmp_out}/h"
    for n in range(5):
        sinks.write_history(_epoch(spark, 3, [n] * 4), base, "r", n)
    sinks.write_history(_epoch(spark, 1, [9]), base, "other", 0)
    cols = ["match_id", "player_id", "goles", "run_id", "batch_id"]
    want, every = (_rows(sinks.read_history(spark, base, *x), cols) for x in (("r",), ()))
    assert sinks.compact_history(spark, base, "r") == 4
    assert sinks.compact_history(spark, base, "r") == 4  # nothing new
    assert _rows(sinks.read_history(spark, base, "r"), cols) == want and _rows(sinks.read_history(spark, base), cols) == every
    assert len(sinks.read_history(spark, base, "r").inputFiles()) == 1
    assert _rows(spark.read.parquet(base), cols) == every  # a reader that lists the epochs
    sinks.write_history(_epoch(spark, 1, [7]), base, "r", 5)
    want = sorted(want + [("m", "0", 7, "r", 5)])
    assert _rows(sinks.read_history(spark, base, "r"), cols) == want
    assert sinks.expire_epochs(spark, base, "r") == [0, 1, 2, 3, 4]
    assert _rows(sinks.read_history(spark, base, "r"), cols) == want
    assert sinks.compact_latest(spark, base, f"{tmp_out}/s", "r") == 5
    assert sinks.compact_history(spark, base, "r") == 5 and sinks.expire_epochs(spark, base, "r") == [5]
    assert _rows(sinks.read_history(spark, base, "r"), cols) == want and subfolders(spark, f"{base}/run_id=r") == []
    assert sinks.compact_history(spark, base, "no such run") is None and sinks.expire_epochs(spark, base, "other") == []


def test_last_epoch_is_the_last_committed_one(spark, tmp_out):
    ev = events_from_table(spark, SF_SMALL)
    encode_events(ev).select("value").repartition(4).write.text(f"{tmp_out}/in")
    out = f"{tmp_out}/o"
    history, run = run_replay(spark, f"{tmp_out}/in", out_base=out, run_id="c", output_mode="complete", max_files_per_trigger=1, with_bulk=False)
    checkpoint = checkpoint_path(out, run)
    n = sinks.committed_epoch(spark, checkpoint)
    last = sinks.read_last_epoch(spark, history, run, checkpoint)
    assert n >= 3 and _rows(last) == _rows(player_metrics(ev))
    assert {f.split("batch_id=")[1].split("/")[0] for f in last.inputFiles()} == {str(n)}
    # an epoch that was written but not committed is not read
    sinks.write_history(player_metrics(ev.limit(10)), history, run, n + 1)
    assert _rows(sinks.read_last_epoch(spark, history, run, checkpoint)) == _rows(player_metrics(ev))
    with pytest.raises(ValueError):
        sinks.read_last_epoch(spark, history, "no such run", checkpoint)


@pytest.mark.parametrize("documents", [False, True])
def test_state_equals_batch_metrics(spark, tmp_out, documents):
    ev = events_from_table(spark, SF_SMALL)
    encode_events(ev).select("value").repartition(3).write.text(f"{tmp_out}/in")
    out = f"{tmp_out}/o"
    history, run = run_replay(spark, f"{tmp_out}/in", out_base=out, run_id="s", max_files_per_trigger=1, with_bulk=False,
                              rocksdb=True, state_partitions=3, with_documents=documents)
    checkpoint = checkpoint_path(out, run)
    assert _rows(metrics_from_state(spark, checkpoint)) == _rows(player_metrics(ev))
    assert read_state(spark, checkpoint).select("partition_id").distinct().count() <= 3
    first = sinks.read_history(spark, history, run).filter("batch_id = 0")
    assert _rows(metrics_from_state(spark, checkpoint, 0)) == _rows(first)


def test_foreign_state_is_refused(spark, tmp_out):
    spark.range(5).write.parquet(f"{tmp_out}/in")
    q = (spark.readStream.schema("id long").parquet(f"{tmp_out}/in").groupBy("id").count().writeStream.outputMode("update")
         .format("noop").option("checkpointLocation", f"{tmp_out}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    with pytest.raises(ValueError):
        read_state(spark, f"{tmp_out}/c")


def test_epoch_keeps_its_roster_version(spark, tmp_out):
    roster = lambda v: spark.createDataFrame([("7", "M", float(v), 60.0, "80")], "id string, genero string, velocidad double, resistencia double, media string")
    versions = RosterVersions(spark, f"{tmp_out}/rosters")
    prepare = join_roster(f"{tmp_out}/rosters", f"{tmp_out}/epochs")
    df = player_metrics(events_df(spark, [{}, {"player_id": "8"}]))

    def seen(epoch):
        return {r.player_id: (r.velocidad, r.version_plantilla) for r in prepare(df, epoch).collect()}
    assert seen(0) == {"7": (None, None), "8": (None, None)}
    assert versions.publish(roster(70)) == 0
    assert seen(1) == {"7": (70.0, 0), "8": (None, 0)}
    assert versions.publish(roster(75)) == 1
    assert seen(2)["7"] == (75.0, 1)
    assert seen(1)["7"] == (70.0, 0) and seen(0)["7"] == (None, None)  # run again after a failure
