"""What the replays write grows with the events, not with events times epochs."""

from pathlib import Path

from helpers import SF_SMALL, events_df
from touchline.operators.metrics import METRIC_COLUMNS, player_metrics
from touchline.plans import registry_stream as R
from touchline.schemas import METRIC_KEYS
from touchline.sources.events import encode_events, event_columns, events_from_table, read_event_files
from touchline.streaming import documents

COLS = METRIC_KEYS + METRIC_COLUMNS


def _rows(df, cols=COLS):
    return sorted(map(repr, df.select(*cols).collect()))


def _bytes(folder):
    return sum(p.stat().st_size for p in Path(folder.removeprefix("file:")).rglob("part-*"))


def test_documents_are_written_in_proportion_to_the_epochs_rows(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(documents, "RUNS", 3, raising=False)
    base = f"{tmp_out}/d"
    table = documents.DocumentTable(spark, base, buckets=2)
    seen, after = {}, []
    for epoch in range(6):
        ids = range(40) if epoch == 0 else range(4 * epoch, 4 * epoch + 4)
        new = [{"player_id": str(i), "player_nombre": f"P{i}", "timestamp": float(epoch), "x": float(epoch)} for i in ids]
        seen |= {r["player_id"]: r for r in new}
        table.upsert(player_metrics(events_df(spark, new), last_event=True), epoch)
        after.append(_rows(player_metrics(events_df(spark, list(seen.values())))))
    assert _rows(table.read()) == after[5] and _rows(table.read(3)) == after[3]
    written = sum(spark.read.parquet(f"{base}/epoch={n}").count() for n in range(6))
    assert written < 120  # 60 rows came in; a table written anew by each epoch has 240
    table.expire(keep=1)
    assert _rows(table.read()) == after[5]


def test_published_events_are_packed_and_whole(spark, monkeypatch):
    monkeypatch.setattr(R, "_DONE", {})
    monkeypatch.setattr(R, "FILE_ROWS", 50, raising=False)
    ev = events_from_table(spark, SF_SMALL)
    text = sum(len(r.value) for r in encode_events(ev).select("value").collect())
    path = R.event_files(spark, SF_SMALL)
    cols = event_columns()
    assert _rows(read_event_files(spark, path), cols) == _rows(ev, cols)
    assert _bytes(path) < text / 2
    parts, files = R.published(spark, SF_SMALL)
    assert parts == path and files > 1 and len(list(Path(path.removeprefix("file:")).glob("part-*"))) >= R.EVENT_FILES * files


def test_slices_are_packed_and_whole(spark, monkeypatch):
    monkeypatch.setattr(R, "_DONE", {})
    monkeypatch.setattr(R, "FILE_ROWS", 50, raising=False)
    ev = events_from_table(spark, SF_SMALL)
    text = sum(len(r.value) for r in encode_events(ev).select("value").collect())
    path, files = R.slice_files(spark, SF_SMALL)
    assert _bytes(path) < text / 2 and files > 1
    cols = event_columns()
    for k in (0, 7):
        own = ev.where(f"event_id % {R.EVOLUTION_SLICES} = {k}")
        assert _rows(read_event_files(spark, f"{path}/slice={k}/*"), cols) == _rows(own, cols)
