"""Status history: events, their table, and the fold to the present state."""

from datetime import datetime

from quartermill import schemas
from quartermill.operators import history, queue

START, END, LATER = "2026-01-15 08:30:00", "2026-01-15 09:00:00", "2026-01-16 08:30:00"
FILES = [("B1", "S1", "QUEUED", "QUARTER"), ("B2", "S2", "QUEUED", "QUARTER"), ("B3", "S3", "GENERATED", "QUARTER"), ("B4", None, "QUEUED", "PERIODIC")]


def files(spark, rows=FILES):
    return spark.createDataFrame([(b, s, 1996, 1, None, None, status, kind) for b, s, status, kind in rows], schemas.QUEUE)


def outcome(spark, counts):
    return spark.createDataFrame([(s, 1996, 1, n, False) for s, n in counts.items()], "site_id string, year int, quarter int, record_count long, skipped boolean")


def run(spark, path, of, counts, run_id, start, end=None):
    organization = spark.createDataFrame([(1, "01", "C1", "S1"), (2, "01", "C2", "S2")], schemas.ORGANIZATION)
    entries = history.started(of, run_id, start)
    history.write_events(entries, path)
    if end:
        changes = queue.status_changes(of, outcome(spark, counts), organization, start)
        history.write_events(history.ended(changes, entries, run_id, end), path)


def state(spark, path):
    rows = history.folded(files(spark), history.read_events(spark, path)).collect()
    return {r.batch_id: r.asDict() for r in rows}


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "events")
    run(spark, path, files(spark), {"S1": 5, "S2": None}, "r1", START, END)
    once = state(spark, path)
    run(spark, path, files(spark), {"S1": 5, "S2": None}, "r1", START, END)
    assert state(spark, path) == once and history.read_events(spark, path).count() == 4
    assert {b: (r["status"], r["attempts"], r["record_count"]) for b, r in once.items()} == {
        "B1": ("GENERATED", 1, 5), "B2": ("FAILED", 1, None), "B3": ("GENERATED", 0, None), "B4": ("QUEUED", 0, None),
    }
    assert once["B2"]["error_message"] == "No worker data found for site: S2" and once["B4"]["created_at"] is None
    assert once["B1"]["outbound_file_name"] == "QTR_S1_Q1_1996_20260115_083000.txt"
    # Equal events count once.
    events = history.read_events(spark, path)
    twice = history.folded(files(spark), events.unionByName(events)).collect()
    assert {r.batch_id: r.asDict() for r in twice} == once


def test_later_events_win_and_leave_what_they_do_not_set(spark, tmp_path):
    path = str(tmp_path / "events")
    run(spark, path, files(spark), {"S1": 5, "S2": None}, "r1", START, END)
    failed = history.requeued(history.folded(files(spark), history.read_events(spark, path)))
    failed = spark.createDataFrame(failed.collect(), schemas.QUEUE)
    assert [r.batch_id for r in failed.collect()] == ["B2"]
    # The run starts, a look at the state shows it, then it ends.
    run(spark, path, failed, {}, "r2", LATER)
    open_ = state(spark, path)["B2"]
    assert (open_["status"], open_["attempts"], open_["error_message"]) == ("GENERATING", 2, "No worker data found for site: S2")
    current = history.folded(files(spark), history.read_events(spark, path))
    assert [r.batch_id for r in history.unfinished(current, "2026-01-17 00:00:00").collect()] == ["B2"]
    assert history.unfinished(current, LATER).count() == 0
    assert history.requeued(current, ("GENERATING",)).count() == 1 and history.requeued(current, ("GENERATING",), most=2).count() == 0
    # A start and an end of one time: the end counts.
    run(spark, path, failed, {"S2": 7}, "r2", LATER, LATER)
    done = state(spark, path)["B2"]
    assert (done["status"], done["attempts"], done["record_count"]) == ("GENERATED", 2, 7)
    assert (done["created_at"], done["updated_at"]) == (datetime(2026, 1, 15, 8, 30), datetime(2026, 1, 16, 8, 30))


def test_entries_stand_without_a_queue_row(spark, tmp_path):
    path = str(tmp_path / "events")
    extra = files(spark, [("B9", "S1", "QUEUED", "QUARTER")])
    run(spark, path, extra, {"S1": 3}, "r1", START, END)
    own = state(spark, path)["B9"]
    assert (own["status"], own["record_count"], own["file_type"]) == ("GENERATED", 3, "QUARTER")
    assert history.folded(files(spark).limit(0), history.read_events(spark, path)).count() == 1


def test_the_fold_is_one_aggregate(spark, tmp_path):
    path = str(tmp_path / "events")
    run(spark, path, files(spark), {"S1": 5}, "r1", START, END)
    plan = history.folded(files(spark), history.read_events(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan and "Window" not in plan
