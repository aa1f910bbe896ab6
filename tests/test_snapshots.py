"""Tables that change together: lost writers, two writers, whole days, and the stored backup cycle."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import backups
from fleetscope.plans import backup_cycle
from fleetscope.sinks import snapshots
from fleetscope.sinks.snapshots import Snapshot
from workload import fixtures as fx

SMALL = "/root/testdata/sf0.001"
CREATED = backup_cycle.CREATED
SETS, HISTORY = backup_cycle.SETS, backup_cycle.HISTORY


def day(number):
    return dt.datetime(2024, 1, number, 12)


def set_row(number, created, **values):
    names = ("set_id backup_set_id database name first_lsn last_lsn backup_start_date backup_finish_date size_kb type "
             "file_name recovery_model is_damaged machine create_datetime server").split()  # fmt: skip
    given = {"set_id": number, "database": f"db{number}", "create_datetime": created, "server": "S"} | values
    return tuple(given.get(n) for n in names)


def history_row(number, created, running=True):
    return number + 100, number, "job", running, False, None, created, None, created, "S"


@pytest.fixture()
def place(tmp_path):
    return f"file:{tmp_path}/tracking"


@pytest.fixture()
def stored(spark, rows, place):
    """Both tables over three days, and a row without a day."""
    sets = rows(SETS, *[set_row(i, day(i)) for i in (1, 2, 3)], set_row(4, day(3)), set_row(5, None))
    history = rows(HISTORY, *[history_row(i, day(i)) for i in (1, 2, 3)], history_row(4, day(3)), history_row(5, None))
    return snapshots.commit(spark, Snapshot(place), CREATED, {SETS: sets, HISTORY: history})


def ids(spark, state, table=SETS):
    return sorted(r.set_id for r in snapshots.open_parts(spark, state, table).collect())


def files_of(place):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(place.removeprefix("file:")) for f in names if f.startswith("part-")
    }


def test_a_commit_is_read_back_by_day(spark, stored, place):
    read = snapshots.current(spark, place)
    assert read == stored and read.number == 1
    assert ids(spark, read) == ids(spark, read, HISTORY) == [1, 2, 3, 4, 5]
    assert sorted(str(p.day) for p in read.of(SETS)) == ["2024-01-01", "2024-01-02", "2024-01-03", "None"]
    assert snapshots.open_parts(spark, read, SETS).schema == snapshots.open_parts(spark, Snapshot(place), SETS).schema


def test_nothing_is_stored_at_first(spark, place):
    state = snapshots.current(spark, place)
    assert state == Snapshot(place) and snapshots.open_parts(spark, state, SETS).isEmpty()
    assert snapshots.sweep(spark, place) == 0


@pytest.mark.parametrize("lost_at", ["second table", "rename"])
def test_a_lost_driver_leaves_the_old_pair(spark, rows, stored, place, monkeypatch, lost_at):
    """The driver dies after the first table was written, or after both."""
    if lost_at == "rename":
        monkeypatch.setattr(snapshots, "_put", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    else:
        write = snapshots._write

        def once(frame, location, table, day_of):
            if table == HISTORY:
                raise KeyboardInterrupt
            return write(frame, location, table, day_of)

        monkeypatch.setattr(snapshots, "_write", once)
    before = files_of(place)
    with pytest.raises(KeyboardInterrupt):
        snapshots.commit(spark, stored, CREATED, {SETS: rows(SETS, set_row(9, day(4))), HISTORY: rows(HISTORY, history_row(9, day(4)))})
    monkeypatch.undo()
    assert snapshots.current(spark, place) == stored and ids(spark, snapshots.current(spark, place)) == [1, 2, 3, 4, 5]
    assert len(files_of(place)) > len(before)
    assert snapshots.sweep(spark, place) >= 1 and files_of(place) == before


def test_of_two_writers_the_second_fails(spark, rows, stored, place):
    first = snapshots.commit(spark, stored, CREATED, {SETS: rows(SETS, set_row(6, day(4)))})
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, stored, CREATED, {SETS: rows(SETS, set_row(7, day(4)))})
    assert snapshots.current(spark, place) == first and ids(spark, first) == [1, 2, 3, 4, 5, 6]
    again = snapshots.commit(spark, first, CREATED, {SETS: rows(SETS, set_row(7, day(4)))})
    assert again.number == 3 and ids(spark, again) == [1, 2, 3, 4, 5, 6, 7]


def test_a_reader_of_the_old_snapshot_is_not_disturbed(spark, stored, place):
    old = snapshots.open_parts(spark, stored, SETS)
    snapshots.drop_days(spark, stored, CREATED, dt.date(2024, 1, 3), (SETS, HISTORY))
    assert old.count() == 5
    assert snapshots.sweep(spark, place, keep=2) == 0  # the newest two snapshots stay readable
    assert snapshots.sweep(spark, place, keep=1) == 6


def test_days_are_dropped_without_reading(spark, stored, place):
    before = files_of(place)
    for file in before:
        if "day=2024-01-01" in file:
            os.truncate(file, 3)  # reading it would fail
    before = files_of(place)
    state = snapshots.drop_days(spark, stored, CREATED, dt.date(2024, 1, 2), (SETS, HISTORY))
    assert ids(spark, state) == ids(spark, state, HISTORY) == [2, 3, 4]
    snapshots.sweep(spark, place, keep=1)
    after = files_of(place)
    assert set(after) == {f for f in before if "day=2024-01-0" in f and "day=2024-01-01" not in f}
    assert all(after[f] == before[f] for f in after)
    assert snapshots.drop_days(spark, state, CREATED, dt.date(2024, 1, 2), (SETS, HISTORY)) is state


def test_a_change_rewrites_touched_days_only(spark, rows, stored, place):
    before = files_of(place)
    keys = rows("server string, set_id long", ("S", 3), ("S", 77), ("T", 1))

    def rename(parts):
        assert ids_of(parts[SETS]) == [3, 4]  # the day of set 3
        return {t: f.withColumn("server", F.when(F.col("set_id") == 3, "X").otherwise(F.col("server"))) for t, f in parts.items()}

    def ids_of(frame):
        return sorted(r.set_id for r in frame.collect())

    state = snapshots.change(spark, stored, CREATED, {SETS: keys, HISTORY: keys}, backups.SET, rename)
    assert ids(spark, state) == ids(spark, state, HISTORY) == [1, 2, 3, 4, 5]
    assert [r.set_id for r in snapshots.open_parts(spark, state, SETS).filter("server = 'X'").collect()] == [3]
    kept = {p for t in (SETS, HISTORY) for p in stored.of(t)} & {p for t in (SETS, HISTORY) for p in state.of(t)}
    assert sorted(str(p.day) for p in kept) == ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-02", "None", "None"]
    assert all(files_of(place)[f] == t for f, t in before.items())
    nothing = rows("server string, set_id long", ("S", 99))
    assert snapshots.change(spark, state, CREATED, {SETS: nothing}, backups.SET, rename) is state


# --- The stored backup cycle -----------------------------------------------------------


@pytest.fixture()
def tracking(spark, place):
    stored = {SETS: fx.backup_sets(spark, SMALL), HISTORY: fx.backup_history(spark, SMALL)}
    snapshots.commit(spark, Snapshot(place), CREATED, stored)
    return place


def sorted_rows(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=repr)


def test_a_decision_is_stored_in_both_tables(spark, tracking):
    before = backup_cycle.stored_tables(spark, snapshots.current(spark, tracking))
    state, names = backup_cycle.run_decision(spark, tracking, fx.databases(spark, SMALL), fx.AS_OF)
    sets, history = backup_cycle.stored_tables(spark, state)
    assert sets.count() - before[0].count() == history.count() - before[1].count() == names.count() > 0
    assert history.filter("is_running").join(sets, backups.SET, "left_anti").filter(f"set_id > {before[0].count()}").isEmpty()
    # What runs already is not decided again.
    again, none = backup_cycle.run_decision(spark, tracking, fx.databases(spark, SMALL), fx.AS_OF)
    full = backup_cycle.decide(fx.databases(spark, SMALL), history, sets, fx.AS_OF)
    assert none.count() == full.names.count() and again.number == state.number + 1


def test_what_is_recorded_equals_the_whole_tables(spark, tracking):
    state = snapshots.current(spark, tracking)
    facts = fx.backup_completions(spark, SMALL), fx.backup_tracked(spark, SMALL), fx.backupset(spark, SMALL)
    want = backup_cycle.record(*backup_cycle.stored_tables(spark, state), *facts, fx.AS_OF)
    got = backup_cycle.stored_tables(spark, backup_cycle.run_record(spark, tracking, *facts, fx.AS_OF))
    assert [sorted_rows(g) for g in got] == [sorted_rows(w) for w in want]


@pytest.mark.parametrize("days", [backups.RETENTION_DAYS, 1, backups.RESET])
def test_dropped_days_equal_the_filter(spark, tracking, days):
    tables = backup_cycle.stored_tables(spark, snapshots.current(spark, tracking))
    want = [sorted_rows(backups.backup_retention(t, fx.AS_OF, days)) for t in tables]
    got = backup_cycle.stored_tables(spark, backup_cycle.run_retention(spark, tracking, fx.AS_OF, days))
    assert [sorted_rows(t) for t in got] == want
