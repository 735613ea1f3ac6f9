import itertools
import json
import random
from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry_points
from bindings import queries_health
from bindings.crm import LINE_ITEM_ORDER, Crm
from conftest import rows_of
from revstream.operators import quality
from revstream.operators.dedup import dedup_latest, newest_first
from revstream.plans import monitor, staging
from revstream.session import RELEASE
from revstream.sources.tables import Table

NOW = datetime(2026, 4, 20, 12)
PIPES = "pipe_name string, state string, pending int, failed int"


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("a", "RUNNING", 0, 0), ("b", "RUNNING", 0, 0)], dict(all_pipes_ready=True, max_pending=0, all_running=True)),
        ([("a", "RUNNING", 5, 0), ("b", "RUNNING", 0, 2)], dict(all_pipes_ready=False, max_pending=5, any_failed_files=True)),
        ([("a", "ERROR", -1, -1), ("b", "RUNNING", 0, 0)], dict(all_pipes_ready=False, max_pending=0, any_pipe_errors=True, all_running=True)),
        ([("a", "PAUSED", 0, 0)], dict(all_pipes_ready=True, all_running=False)),
        ([("a", "ERROR", -1, -1)], dict(all_pipes_ready=False, max_pending=0, all_running=True)),
    ],
)
def test_ingest_health(spark, rows, expected):
    got = monitor.ingest_health(spark.createDataFrame(rows, PIPES)).first().asDict()
    assert {k: got[k] for k in expected} == expected


# Hours are counted by the clock hours crossed, so 09:30 to 12:00 is three.
@pytest.mark.parametrize("age, fires", [(timedelta(hours=3), True), (timedelta(hours=2, minutes=30), True), (timedelta(hours=2), False)])
def test_stale_alert(spark, age, fires):
    table = spark.createDataFrame([(NOW - age,)], "_load_timestamp timestamp_ntz")
    assert (monitor.stale_alert(table, NOW).count() == 1) is fires


@pytest.mark.parametrize("hours, status", [(1, "pass"), (2, "pass"), (3, "warn"), (6, "warn"), (7, "error")])
def test_freshness(spark, hours, status):
    table = spark.createDataFrame([(NOW - timedelta(hours=hours),)], "_load_timestamp timestamp_ntz")
    assert quality.freshness({"t": table}, NOW).first().status == status


def test_freshness_of_an_empty_table_is_an_error(spark):
    empty = spark.createDataFrame([], "_load_timestamp timestamp_ntz")
    assert quality.freshness({"t": empty}, NOW).first().status == "error"


def test_checks_on_planted_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "z", -1), (None, None, 101), (None, "a", None)], "id int, kind string, n int")
    assert [(r.id, r.n_records) for r in quality.unique(df, "id").collect()] == [(1, 2)]
    assert quality.not_null(df, "id").count() == 2
    assert [r.kind for r in quality.accepted_values(df, "kind", ["a"]).collect()] == ["z"]
    assert sorted(r.n for r in quality.accepted_range(df, "n", 0, 100).collect()) == [-1, 101]
    assert rows_of(quality.not_negative(df, "n")) == [(-1, 1)]
    checks = [
        quality.Check("t", "not_null", "id"),
        quality.Check("t", "unique", "id", "warn"),
        quality.Check("t", "accepted_values", "kind", values=("a", "z")),
        quality.Check("t", "accepted_range", "n", "warn", low=0),
        quality.Check("absent", "not_null", "id"),
    ]
    got = {(r.check_name, r.failures, r.status) for r in quality.run_checks({"t": df}, checks).collect()}
    assert got == {("not_null", 2, "error"), ("unique", 1, "warn"), ("accepted_values", 0, "pass"), ("accepted_range", 1, "warn")}


def test_failing_rows_are_kept_once_with_all_their_checks(spark, folder):
    df = spark.createDataFrame([(1, "a", 5), (1, "z", -1), (None, "z", -5), (None, "a", 3)], "id int, kind string, n int")
    checks = [quality.Check("t", "not_null", "id"), quality.Check("t", "unique", "id"), quality.Check("t", "accepted_values", "kind", values=("a",)), quality.Check("t", "accepted_range", "n", low=0)]
    table = Table(spark, folder)
    results = quality.run_checks({"t": df}, checks, failures=table)
    kept = sorted((tuple(r.checks), json.loads(r.failing_row)) for r in table.read().collect())
    assert kept == [
        (("accepted_values(kind)", "accepted_range(n)"), {"id": 1, "kind": "z", "n": -1}),
        (("not_null(id)",), {"kind": "a", "n": 3}),
        (("not_null(id)", "accepted_values(kind)", "accepted_range(n)"), {"kind": "z", "n": -5}),
        (("unique(id)",), {"id": 1, "n_records": 2}),
    ]
    assert {r.check_name: r.failures for r in results.collect()} == {"not_null": 2, "unique": 1, "accepted_values": 2, "accepted_range": 2}


def test_freshness_reads_the_load_time_of_its_feed(spark):
    table = spark.createDataFrame([(NOW - timedelta(hours=1), NOW - timedelta(hours=9))], "_load_timestamp timestamp_ntz, _fivetran_synced timestamp_ntz")
    assert [quality.freshness({"t": table}, NOW, source=s).first().status for s in ("landing", "connector")] == ["pass", "error"]


LOADS = "pipe_name string, file_name string, last_load_time timestamp_ntz, error_count long"


def loads(spark, outcomes, pipe="p", every=timedelta(hours=5), end=NOW):
    rows = [(pipe, f"f{i}", end - every * (len(outcomes) - 1 - i), int(x)) for i, x in enumerate(outcomes)]
    return spark.createDataFrame(rows, LOADS)


@pytest.mark.parametrize("block", ["hour", "day", "year"])
def test_runs_of_outcomes_do_not_depend_on_the_blocks(spark, block):
    outcomes = "".join(random.Random(3).choice("0001112") for _ in range(60))
    want = [(k, len(list(g))) for k, g in itertools.groupby(x != "0" for x in outcomes)]
    runs = monitor.outcome_runs(loads(spark, outcomes), block).orderBy("run").collect()
    assert [(r.failed, r.loads) for r in runs] == want and [r.run for r in runs] == list(range(len(want)))


@pytest.mark.parametrize(
    "outcomes, silent, state",
    [("0000", 0, "RUNNING"), ("0111", 0, "ERROR"), ("1101", 0, "RUNNING"), ("0011", 0, "RUNNING"), ("0000", 26, "STALLED"), ("0000", 24, "RUNNING"), ("111", 90, "ERROR"), ("0", 900, "RUNNING")],
)
def test_pipe_state(spark, outcomes, silent, state):
    got = monitor.pipe_states(loads(spark, outcomes, end=NOW - timedelta(hours=silent)), NOW).first()
    assert got.state == state
    assert got.trailing_errors == len(outcomes) - len(outcomes.rstrip("1"))


def test_pipe_without_loads_is_idle(spark):
    landed = spark.createDataFrame([("p", "f0"), ("p", "f9"), ("q", "x")], "pipe_name string, file_name string")
    assert rows_of(monitor.pipe_status(landed, loads(spark, "10"), NOW)) == [("p", "RUNNING", 1, 1), ("q", "IDLE", 1, 0)]


def test_stale_alert_looks_at_the_loads_of_every_day(spark, folder):
    events = "event_id long, ts timestamp_ntz, event_type string"
    for at, old in ((datetime(2024, 1, 30, 9, 15), 15), (datetime(2024, 1, 30, 23, 30), None)):
        path = f"{folder}/{at.hour}"
        rows = [(1, datetime(2024, 1, 28, 5), "click"), (2, datetime(2024, 1, 29, 23, 59), "view"), (3, at, "view")]
        spark.createDataFrame(rows, events).write.parquet(f"{path}/events.parquet")
        got = entry_points.queries()["stale_alert"](spark, path).collect()
        assert [(r.latest_load, r.hours_old) for r in got] == ([(at, old)] if old else [])


def test_line_items_are_deduplicated_once_for_all_their_checks(spark, sf_dir):
    crm = Crm(spark, sf_dir)
    tables = queries_health._checked(crm)
    for name in ("src_opportunity_line_item", "stg_line_items", "opportunity_enriched"):
        assert not any("lineitem.parquet" in f for f in tables[name].inputFiles())
    want = dedup_latest(crm.raw("OpportunityLineItem"), "id", newest_first(*LINE_ITEM_ORDER))
    assert rows_of(tables["stg_line_items"]) == rows_of(staging.stage(want, "OpportunityLineItem"))


def test_checks_of_each_table_release_their_shuffle_files(spark, monkeypatch):
    """All checks in one plan keep the shuffle files of every uniqueness check until the last has ended."""
    before, seen, plain = spark.conf.get(RELEASE), [], quality.failing_rows
    monkeypatch.setattr(quality, "failing_rows", lambda tables, checks=None: (seen.append((list(tables), spark.conf.get(RELEASE))), plain(tables, checks))[1])
    users = spark.createDataFrame([(1, "a"), (1, None)], "user_id long, email string")
    tasks = spark.createDataFrame([(1,), (2,)], "task_id long")
    got = {(r.table_name, r.check_name, r.column_name): r.failures for r in quality.run_checks({"stg_users": users, "stg_tasks": tasks, "other": tasks}).collect()}
    assert sorted(seen) == [(["stg_tasks"], "true"), (["stg_users"], "true")] and spark.conf.get(RELEASE) == before
    assert got["stg_users", "unique", "user_id"] == 1 and got["stg_users", "not_null", "email"] == 1 and got["stg_tasks", "unique", "task_id"] == 0
    with pytest.raises(ValueError, match="no check"):
        quality.run_checks({"other": tasks})
