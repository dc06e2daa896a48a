"""STR2: overwritten files as events of a stream whose offset is a listing."""

import os

from pyspark.sql import functions as F

from ledgerspark.streaming import landing_events as ev
from ledgerspark.streaming import refresh


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def _trigger(spark, root, batches):
    """One run of the stream, as after a restart: the events of new micro-batches."""
    events = ev.landing_events(spark, f"{root}/in", f"{root}/state", glob="*.xlsx")
    before = set(batches)

    def on_batch(df, n):
        batches[n] = sorted((r.name, r.event, r.length) for r in df.collect())

    refresh.await_all(events.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{root}/ck")
                      .trigger(availableNow=True).start())
    return [e for n in sorted(set(batches) - before) for e in batches[n]]


def test_an_overwritten_file_is_one_event_and_a_restart_none(spark, tmp_path):
    root, batches = str(tmp_path), {}
    _put(f"{root}/in", "a.xlsx", "1")
    _put(f"{root}/in", "b.xlsx", "22")
    _put(f"{root}/in", "c.csv", "x")
    _put(f"{root}/in", "~$a.xlsx", "lock")
    assert _trigger(spark, root, batches) == [("a.xlsx", "new", 1), ("b.xlsx", "new", 2)]
    assert _trigger(spark, root, batches) == []
    _put(f"{root}/in", "a.xlsx", "333")
    _put(f"{root}/in", "d.xlsx", "4")
    assert _trigger(spark, root, batches) == [("a.xlsx", "overwritten", 3), ("d.xlsx", "new", 1)]
    assert _trigger(spark, root, batches) == []
    os.remove(f"{root}/in/b.xlsx")
    assert _trigger(spark, root, batches) == []
    _put(f"{root}/in", "b.xlsx", "22")
    assert _trigger(spark, root, batches) == [("b.xlsx", "new", 2)]
    assert len(os.listdir(f"{root}/state")) <= 2  # committed listings go


def test_a_replayed_batch_gives_the_same_events(tmp_path):
    root = str(tmp_path)
    reader = ev.LandingEventsReader(f"{root}/in", f"{root}/state", "*.xlsx", False)
    assert reader.latestOffset() == {"manifest": 0}  # the landing does not exist yet
    _put(f"{root}/in", "a.xlsx", "1")
    one = reader.latestOffset()
    _put(f"{root}/in", "a.xlsx", "22")
    two = ev.LandingEventsReader(f"{root}/in", f"{root}/state", "*.xlsx", False).latestOffset()

    def events(start, end):
        return [r[1:3] + r[4:] for p in reader.partitions(start, end) for r in p.rows]

    assert events(reader.initialOffset(), one) == [("a.xlsx", 1, "new")]
    for _ in range(2):
        assert events(one, two) == [("a.xlsx", 2, "overwritten")]
    reader.commit(one)
    assert events(one, two) == [("a.xlsx", 2, "overwritten")]
    assert reader.latestOffset() == two


def test_many_files_and_times(spark, tmp_path):
    root = str(tmp_path)
    for k in range(60):
        _put(f"{root}/in/deep", f"{k}.xlsx", "x" * k)
    events = ev.landing_events(spark, f"{root}/in", f"{root}/state", recursive=True)
    out = f"{root}/out"
    refresh.await_all(events.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{root}/ck")
                      .trigger(availableNow=True).start())
    got = spark.read.parquet(out)
    assert got.count() == 60 and got.select("path").distinct().count() == 60
    stamp = os.stat(f"{root}/in/deep/7.xlsx").st_mtime
    seen = got.where("name = '7.xlsx'").select(F.unix_millis("modificationTime").alias("ms"), "length").first()
    assert abs(seen.ms / 1000 - stamp) < 0.01 and seen.length == 7


def test_watch_once_repeats_a_failed_refresh_and_then_rests(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from ledgerspark import cli

    root = str(tmp_path)
    _put(f"{root}/in", "a.xlsx", "1")
    outcome = {"fail": True}
    monkeypatch.setattr(cli, "ledgers", lambda *a: (None, None, None, []))

    def build(*_):
        if outcome["fail"]:
            raise ValueError("half a workbook")
        return spark.range(outcome["rows"])

    monkeypatch.setattr(cli, "build_report", build)
    args = SimpleNamespace(out=f"{root}/out", landing=f"{root}/in", checkpoint=f"{root}/ck", variant="current", ledger_format="workbook",
                           versioned=False, key_mode="strict", once=True, every=1, glob="*.xlsx")

    def shown():
        report = refresh.published(spark, f"{root}/out/resultado_current", f"{root}/out/refresh_log")
        return None if report is None else report.count()

    cli.run_watch(spark, args)
    assert shown() is None
    outcome.update(fail=False, rows=3)
    cli.run_watch(spark, args)  # nothing new landed, but the failed refresh is repeated
    assert shown() == 3
    outcome["rows"] = 5
    cli.run_watch(spark, args)
    assert shown() == 3
    _put(f"{root}/in", "a.xlsx", "22")
    cli.run_watch(spark, args)
    assert shown() == 5
