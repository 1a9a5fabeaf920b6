"""Jobs that write: reruns change nothing, scopes are respected, history rolls over."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldo.catalogue import HISTORY_SCHEMA
from saldo.functions.dates import Period
from saldo.operators import dedup, guards, reload
from saldo.plans import month, snapshots
from saldo.plans.buffer import TaxBuffer, tax_buffer
from saldo.plans.month import GROUPED, UNGROUPED, clean_ledgers, run_buffer, stored_table
from saldo.session import scratch_path, shared_folder
from saldo.sources.demo_views import view_text
from saldo.sources.folders import exists, list_partitions
from saldo.streaming.snapshots import read_stream, stream_snapshots

MONTH = Period(1996, 12)


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stored_run_equals_the_lazy_book_and_repeats(spark, tables):
    out = scratch_path(spark, "run")
    year = Period(1996)
    first = run_buffer(spark, tables, out, year)
    book = tax_buffer(tables, year)
    assert first.count() > 50 and same(first, book)
    ledgers = [stored_table(spark, out, n).collect() for n in (UNGROUPED, GROUPED)]
    # one month of one company again: the rest of the year stays, the whole is unchanged
    again = run_buffer(spark, tables, out, MONTH, company="02")
    assert same(again, book)
    assert [sorted(map(str, stored_table(spark, out, n).collect())) for n in (UNGROUPED, GROUPED)] == [
        sorted(map(str, rows)) for rows in ledgers]
    run = TaxBuffer(tables, year).stage()
    for name, clean in ((UNGROUPED, run.clean_ungrouped()), (GROUPED, run.clean_grouped())):
        assert same(stored_table(spark, out, name).select(*clean.columns), clean)


def test_interrupted_clean_up_loses_nothing(spark, tables, monkeypatch):
    out = scratch_path(spark, "broken")
    year = Period(1996)
    finish, ends = month.finish_clean, iter(range(9))

    def broken(spark, path):
        if exists(spark, f"{path}.cleaned/_SUCCESS"):
            raise RuntimeError(f"lost {next(ends)}")
        finish(spark, path)

    monkeypatch.setattr(month, "finish_clean", broken)
    with pytest.raises(RuntimeError, match="lost 0"):
        run_buffer(spark, tables, out, year)
    rows = stored_table(spark, out, UNGROUPED)
    run = TaxBuffer(tables, year).stage()
    assert same(rows.select(*run.ungrouped.columns), run.ungrouped)  # as loaded, not a row less
    monkeypatch.setattr(month, "finish_clean", finish)
    clean_ledgers(spark, tables, out, year)
    for name, clean in ((UNGROUPED, run.clean_ungrouped()), (GROUPED, run.clean_grouped())):
        assert same(stored_table(spark, out, name).select(*clean.columns), clean)
        assert not exists(spark, f"{out}/{name}.cleaned")


def test_partitions_that_lose_all_rows_are_dropped(spark):
    path = scratch_path(spark, "ledger_ungrouped_of") + f"/{UNGROUPED}"
    schema = stored_table(spark, scratch_path(spark, "none"), UNGROUPED).schema
    row = lambda y, c: tuple({"year_v": y, "mnth": 1, "comp_scala": c}.get(f.name) for f in schema)
    ledger = spark.createDataFrame([row(2008, "01"), row(2008, "02"), row(2008, "02"), row(None, "02")], schema)
    reload.overwrite_partitions(ledger, path)
    ledger.select(*reload.PERIOD_KEYS).distinct().write.parquet(f"{path}.touched")
    ledger.filter("comp_scala = '02' and year_v = 2008").limit(1).write.partitionBy(*reload.PERIOD_KEYS).parquet(f"{path}.cleaned")
    for _ in range(2):
        month.finish_clean(spark, path)
        left = spark.read.schema(schema).parquet(path).collect()
        assert [(r.year_v, r.comp_scala) for r in left] == [(2008, "02")]


def test_run_counts_its_steps_and_leaves_no_scratch(spark, tables):
    out = scratch_path(spark, "run")
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    book, rows = month.run_buffer_steps(spark, tables, out, MONTH, master="31")
    assert rows["book"] == book.count() and rows["operations_buffer"] >= rows["ledger_ungrouped"] >= 0
    assert set(rows) == {"operations_buffer", "advance_wrap", "ledger_ungrouped", "ledger_grouped", "book"}
    left = set(os.listdir(shared_folder(spark).removeprefix("file:"))) - before
    assert left <= {os.path.basename(out)}, left


def test_cleaning_a_missing_ledger_is_no_error(spark, tables):
    clean_ledgers(spark, tables, scratch_path(spark, "none"))


def test_reload_replaces_only_period_and_scope(spark):
    path = scratch_path(spark, "reload")
    schema = "year_v int, mnth int, comp_scala string, v int"
    df = lambda rows: spark.createDataFrame(rows, schema)
    read = lambda: sorted(tuple(r[c] for c in ("year_v", "mnth", "comp_scala", "v"))
                          for r in spark.read.schema(schema).parquet(path).collect())
    reload.reload_period(df([(2008, 11, "01", 1), (2008, 11, "02", 2), (2008, 12, "01", 3)]), path)
    reload.reload_period(df([(2008, 11, "01", 9)]), path, Period(2008, 11), ["01"])
    assert read() == [(2008, 11, "01", 9), (2008, 11, "02", 2), (2008, 12, "01", 3)]
    # company 02 has no rows any more: its partition goes
    for _ in range(2):
        reload.reload_period(df([(2008, 11, "01", 7)]), path, Period(2008, 11))
        assert read() == [(2008, 11, "01", 7), (2008, 12, "01", 3)]
    reload.reload_period(df([]), path, Period(2008, 12))
    assert read() == [(2008, 11, "01", 7)]


def test_deletes_treat_unknown_as_kept(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, gone boolean")
    assert [r.k for r in reload.delete_where(df, F.col("gone")).orderBy("k").collect()] == [2, 3]
    other = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert [r.k for r in reload.delete_matching(df, other, ["k"]).orderBy("k").collect()] == [1, 3]
    with pytest.raises(PySparkException):
        reload.append_columns(df, ["k", "missing"])


def test_slices_resume(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    df = spark.range(1000).selectExpr("id % 300 as k", "id as v")
    dedup.lay_in_slices(df, src, ["k"], 4)
    first = dedup.dedup_in_slices(spark, src, dst, ["k"], ["v"], 4)
    files = sorted(first.inputFiles())
    again = dedup.dedup_in_slices(spark, src, dst, ["k"], ["v"], 4)
    assert sorted(again.inputFiles()) == files
    assert same(again.select("k", "v"), df.groupBy("k").agg(F.max("v").alias("v")))


def test_unique_guard_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    seen, observation = guards.counted(guards.require_unique(df, ["k"]), "step")
    assert same(seen, df) and observation.get["rows"] == 2
    with pytest.raises(PySparkException, match="not unique on k: 2"):
        guards.require_unique(df.union(df.filter("k = 2")), ["k"]).collect()


def history(spark, stamps):
    return spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz").select(
        "ts", F.lit(1).alias("pid"),
        *[F.lit(None).cast("string").alias(c) for c in snapshots.SESSION],
        *[F.lit(None).cast("string" if c in ("command", "state") else "double").alias(c)
          for c in snapshots.METRICS])


def test_history_routes_and_expires(spark):
    path = scratch_path(spark, "history")
    stamps = [datetime(2024, 1, d, 23, 59, 59) for d in range(1, 9)]
    days = [date(2024, 1, d) for d in range(1, 8)]
    snapshots.append_snapshot(history(spark, stamps), None, days, path)
    names = lambda: [p["day"] for p in list_partitions(spark, path, ["day"])]
    assert names() == [*(d.isoformat() for d in days), snapshots.DEFAULT_DAY]
    assert snapshots.retain(spark, path, date(2024, 1, 8)) == [f"2024-01-0{d}" for d in range(1, 5)]
    assert snapshots.retain(spark, path, date(2024, 1, 8)) == []
    assert names() == ["2024-01-05", "2024-01-06", "2024-01-07", snapshots.DEFAULT_DAY]
    assert snapshots.expired_days(["x", "2024-13-01", "2023-01-01"], date(2024, 1, 8), 3) == ["2023-01-01"]


def test_stream_stores_each_row_once(spark):
    inbox, path, seen = (scratch_path(spark, n) for n in ("inbox", "out", "seen"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stream = lambda: spark.sql(view_text("history", "spark"),
                               events=read_stream(spark, inbox, events.schema))
    run = lambda: stream_snapshots(stream(), path, seen,
                                   lambda: [date(2024, 1, 2)]).awaitTermination()
    events.filter("event_id % 2 = 0").write.mode("append").parquet(inbox)
    run()
    events.filter("event_id % 2 = 1").write.mode("append").parquet(inbox)
    run()
    run()
    stored = spark.read.parquet(path)
    assert stored.count() == events.count() and stored.select("utime").distinct().count() == events.count()
    assert {r[0] for r in stored.select("batch").distinct().collect()} == {0, 1}
    assert snapshots.retain(spark, path, date(2024, 1, 8)) == ["2024-01-02"]
    assert spark.read.parquet(path).filter("day = '2024-01-02'").count() == 0


def test_job_and_stream_share_a_history(spark):
    inbox, path, seen = (scratch_path(spark, n) for n in ("inbox", "out", "seen"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(inbox)
    stream = spark.sql(view_text("history", "spark"), events=read_stream(spark, inbox, events.schema))
    nightly = history(spark, [datetime(2024, 1, 2, h) for h in range(3)])
    for as_of in (date(2024, 1, 2), date(2024, 1, 3)):  # repeated on the next day, when other days are open
        snapshots.append_snapshot(nightly, datetime(2024, 1, 2, 5), snapshots.open_days_at(as_of), path)
        snapshots.append_snapshot(nightly, None, snapshots.open_days_at(as_of), path, "replay-1")
        stream_snapshots(stream, path, seen, lambda: snapshots.open_days_at(as_of), "one").awaitTermination()
    stored = snapshots.read_history(spark, path, HISTORY_SCHEMA)
    assert "batch" not in stored.columns and stored.count() == events.count() + 2 * 3
    held = list_partitions(spark, path, ["day", "batch"])
    assert {p["batch"] for p in held} == {"at-20240102T050000000000", "replay-1", "one-0"}
    with pytest.raises(ValueError, match="batch name"):
        snapshots.append_snapshot(nightly, None, [], path, "7")
    snapshots.retain(spark, path, date(2024, 2, 1))
    assert {p["day"] for p in list_partitions(spark, path, ["day"])} == {snapshots.DEFAULT_DAY}


def test_replayed_batch_moves_with_its_days(spark):
    path = scratch_path(spark, "replayed")
    rows = history(spark, [datetime(2024, 1, 2, 1), datetime(2024, 1, 3, 1)])
    for days in ([date(2024, 1, 2)], [date(2024, 1, 3)]):
        snapshots.store_batch(rows, days, path, "5")
    assert snapshots.read_history(spark, path, HISTORY_SCHEMA).count() == 2
    assert [p["day"] for p in list_partitions(spark, path, ["day"])  # the day that is closed now is empty
            if list_partitions(spark, f"{path}/day={p['day']}", ["batch"])] == ["2024-01-03", snapshots.DEFAULT_DAY]


def folder_bytes(path: str) -> int:
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(path) for name in names if name.endswith(".parquet"))


def test_table_is_cleaned_where_it_lies(spark, monkeypatch):
    """Beside the table there is never more than one slice of twenty, a hot key included; the rest is not shuffled."""
    path = scratch_path(spark, "in-place")
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.col("id") - 1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("msg"))
    rows = rows.unionByName(spark.sql("select cast(null as bigint) as k, id as v, 'x' as msg from range(5)"))
    dedup.lay_in_slices(rows, path, ["k"], 20)
    before, most = folder_bytes(path), []
    replace = dedup.replace_folder
    monkeypatch.setattr(dedup, "replace_folder", lambda s, new, old: (
        most.append(folder_bytes(path) + folder_bytes(f"{path}.cleaned") - before), replace(s, new, old)))
    moved = []
    keep = dedup.keep_latest
    monkeypatch.setattr(dedup, "keep_latest", lambda df, *a: (moved.append(df.count()), keep(df, *a))[1])
    got = dedup.dedup_in_place(spark, path, ["k"], ["v"], 20).drop(dedup.SLICE)
    want = keep(rows, ["k"], ["v"])
    assert same(got, want) and got.count() == want.count()
    assert max(most) < 0.1 * before and folder_bytes(path) < 0.8 * before
    doubtful = rows.join(rows.groupBy("k").count().filter("count > 1"), "k").count() + 5
    assert sum(moved) <= 1.05 * doubtful
    most.clear()
    assert dedup.dedup_in_place(spark, path, ["k"], ["v"], 20).count() == want.count()
    assert len(most) < 3  # only a slice in which two keys share a cell by chance is written again


def test_interrupted_cleaning_in_place_goes_on(spark, monkeypatch):
    rows = spark.range(2000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    for drop_first in (False, True):
        path = scratch_path(spark, "broken-in-place")
        dedup.lay_in_slices(rows, path, ["k"], 4)
        replace, calls = dedup.replace_folder, iter(range(99))

        def broken(s, new, old):
            if next(calls) == 2:
                if drop_first:
                    dedup.drop_folder(s, old)
                raise RuntimeError("lost")
            replace(s, new, old)

        with monkeypatch.context() as patch:
            patch.setattr(dedup, "replace_folder", broken)
            with pytest.raises(RuntimeError, match="lost"):
                dedup.dedup_in_place(spark, path, ["k"], ["v"], 4)
        got = dedup.dedup_in_place(spark, path, ["k"], ["v"], 4).drop(dedup.SLICE)
        assert same(got, dedup.keep_latest(rows, ["k"], ["v"])) and got.count() == 700


def test_sketch_has_every_key_with_a_second_row(spark):
    keys = spark.range(5000).select((F.col("id") % 4000).alias("k"))
    for cells in (64, 1 << 20):
        sketch = dedup.key_sketch(keys, cells)
        assert sketch.agg(F.sum(F.length("bits"))).first()[0] <= max(4096, cells // 8)
        marked = dedup.with_second_rows(keys, ["k"], sketch, cells)
        assert marked.filter("k < 1000 and not _second").isEmpty()
    assert marked.filter("_second").count() < 2100
