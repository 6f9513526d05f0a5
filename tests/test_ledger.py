"""Ingest with a ledger: new, repeated, replaced, shrunken and vanished archives."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ontime.streaming import ledger as lg
from tests.test_streaming import csv_text
from tests.test_zipcsv import write_zip


def put(path, dates, age=0):
    write_zip(path, {"a.csv": csv_text(dates)})
    os.utime(path, (time.time() - age,) * 2)


def state(spark, out):
    rows = lg.read_table(spark, out).groupBy("flight_date", lg.ARCHIVE).count().collect()
    return sorted((str(r["flight_date"]), os.path.basename(r[lg.ARCHIVE]), r["count"]) for r in rows)


def test_three_runs_and_a_replaced_archive(spark, scratch):
    raw, out, ledger = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ledger"
    put(f"{raw}/a.zip", ["2019-01-01", "2019-02-01"], 100)
    put(f"{raw}/b.zip", ["2019-01-02", "2019-03-01"], 100)
    first = lg.sync_archives(spark, raw, out, ledger)
    assert first == {"archives": 2, "replaced": 0, "months": 3, "removed": 0}
    assert state(spark, out) == [("2019-01-01", "a.zip", 1), ("2019-01-02", "b.zip", 1), ("2019-02-01", "a.zip", 1), ("2019-03-01", "b.zip", 1)]
    untouched = {f: os.path.getmtime(f"{out}/year=2019/month=3/{f}") for f in os.listdir(f"{out}/year=2019/month=3")}
    assert lg.sync_archives(spark, raw, out, ledger)["archives"] == 0
    put(f"{raw}/a.zip", ["2019-01-05", "2019-04-01"])           # under its name; nothing in February any more
    put(f"{raw}/c.zip", ["2019-01-09"])
    third = lg.sync_archives(spark, raw, out, ledger)
    assert third == {"archives": 2, "replaced": 1, "months": 2, "removed": 1}
    assert state(spark, out) == [("2019-01-02", "b.zip", 1), ("2019-01-05", "a.zip", 1), ("2019-01-09", "c.zip", 1),
                                 ("2019-03-01", "b.zip", 1), ("2019-04-01", "a.zip", 1)]
    assert not os.path.exists(f"{out}/year=2019/month=2")
    assert untouched == {f: os.path.getmtime(f"{out}/year=2019/month=3/{f}") for f in os.listdir(f"{out}/year=2019/month=3")}


def test_a_repeated_batch_changes_nothing(spark, scratch):
    raw, out, ledger = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ledger"
    put(f"{raw}/a.zip", ["2019-01-01"], 100)
    assert lg.sync_archives(spark, raw, out, ledger, batch_id="1")["archives"] == 1
    put(f"{raw}/b.zip", ["2019-01-02"])
    assert lg.sync_archives(spark, raw, out, ledger, batch_id="1")["archives"] == 0
    assert len(state(spark, out)) == 1
    assert lg.sync_archives(spark, raw, out, ledger, batch_id="2")["archives"] == 1
    assert len(state(spark, out)) == 2


@pytest.mark.parametrize("at", ["write_clean", "current_timestamp"])
def test_a_run_that_is_lost_is_made_good_by_the_next(spark, scratch, monkeypatch, at):
    raw, out, ledger = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ledger"
    put(f"{raw}/a.zip", ["2019-01-01", "2019-01-01"], 100)
    lg.sync_archives(spark, raw, out, ledger)
    put(f"{raw}/a.zip", ["2019-01-03"])
    put(f"{raw}/b.zip", ["2019-01-04"])

    def lost(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(lg if at == "write_clean" else F, at, lost)
        with pytest.raises(OSError):
            lg.sync_archives(spark, raw, out, ledger)
    assert lg.sync_archives(spark, raw, out, ledger) == {"archives": 2, "replaced": 1, "months": 1, "removed": 0}
    assert state(spark, out) == [("2019-01-03", "a.zip", 1), ("2019-01-04", "b.zip", 1)]
    assert lg.read_ledger(spark, ledger).count() == 3


def test_faulty_and_vanished_archives(spark, scratch):
    raw, out, ledger = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ledger"
    put(f"{raw}/a.zip", ["2019-01-01"], 100)
    with open(f"{raw}/bad.zip", "wb") as f:
        f.write(b"junk")
    lg.sync_archives(spark, raw, out, ledger)
    held = {os.path.basename(r.path): r for r in lg.current(lg.read_ledger(spark, ledger)).collect()}
    assert held["bad.zip"].error and held["bad.zip"].months == [] and held["a.zip"].rows == 1
    put(f"{raw}/bad.zip", ["2019-01-07"])                       # mended
    os.remove(f"{raw}/a.zip")                                   # gone from the folder: its rows stay
    assert lg.sync_archives(spark, raw, out, ledger)["archives"] == 1
    assert state(spark, out) == [("2019-01-01", "a.zip", 1), ("2019-01-07", "bad.zip", 1)]


def test_fresh_rows_are_staged_without_month_directories(spark, scratch, monkeypatch):
    raw, out, ledger = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ledger"
    put(f"{raw}/a.zip", [f"2019-{m:02d}-01" for m in range(1, 13)])
    left = []
    monkeypatch.setattr(lg, "remove", lambda spark, path: left.append(path.removeprefix("file:")))
    assert lg.sync_archives(spark, raw, out, ledger)["months"] == 12
    staged = next(path for path in left if "ledger-rows" in path)
    assert any(f.endswith(".parquet") for f in os.listdir(staged)) and not any("=" in f for f in os.listdir(staged))
    assert len(state(spark, out)) == 12


def test_empty_folder(spark, scratch):
    os.makedirs(f"{scratch}/raw")
    assert lg.sync_archives(spark, f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ledger")["archives"] == 0
    assert lg.read_table(spark, f"{scratch}/out").count() == 0
