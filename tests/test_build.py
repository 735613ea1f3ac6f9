"""The batch graph over hand-made rows: late rows, deletes, closing deals."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from revstream import session
from revstream.catalog import OBJECTS
from revstream.operators.upsert import merge_in_buckets, merge_upsert
from revstream.plans import build as graph
from revstream.plans.staging import UNIQUE_KEYS, conform, stage
from revstream.session import RELEASE, scratch


def empty(spark, obj):
    ddl = ", ".join(f"{n} {k}" for n, k in crm_columns(obj))
    return spark.createDataFrame([], ddl)


def crm_columns(obj):
    return OBJECTS[obj].columns.items()


def opportunities(spark, rows):
    df = spark.createDataFrame(
        rows, "id string, amount string, isclosed boolean, iswon boolean, isdeleted boolean, systemmodstamp string"
    )
    typed = df.withColumns(
        {"amount": F.col("amount").cast("decimal(38,2)"), "systemmodstamp": F.col("systemmodstamp").cast("timestamp_ntz")}
    )
    return conform(typed, "Opportunity")


def raw(spark, rows):
    return {o: opportunities(spark, rows) if o == "Opportunity" else empty(spark, o) for o in OBJECTS}


FIRST = [
    ("a", "10.00", False, False, False, "2026-01-01 00:00:00"),
    ("b", "20.00", False, False, False, "2026-01-01 00:00:00"),
    ("c", "30.00", True, True, False, "2026-01-01 00:00:00"),
]
SECOND = FIRST + [
    ("a", "11.00", True, True, False, "2026-01-02 00:00:00"),
    ("b", "20.00", False, False, True, "2026-01-02 00:00:00"),
]


@pytest.fixture(scope="module")
def wh(spark):
    from revstream.session import scratch_dir

    path = scratch_dir(spark, "build")
    graph.build(spark, raw(spark, FIRST), path, datetime(2026, 1, 2), buckets=2, checks=False)
    return graph.build(spark, raw(spark, SECOND), path, datetime(2026, 1, 3), buckets=2)


def test_closed_and_deleted_deals_leave_the_pipeline(wh):
    assert wh.read("fct_sales_pipeline").count() == 0
    assert rows_of(wh.read("fct_bookings").select("opportunity_id", F.col("booking_amount").cast("string"))) == [("a", "11.00"), ("c", "30.00")]
    assert rows_of(wh.read("stg_opportunities").select("opportunity_id")) == [("a",), ("c",)]


def test_history_records_update_and_delete(wh):
    h = wh.read("history_opportunities").select("opportunity_id", "is_closed", "valid_to")
    assert rows_of(h) == [
        ("a", False, datetime(2026, 1, 2)),
        ("a", True, None),
        ("b", False, datetime(2026, 1, 3)),
        ("c", True, None),
    ]


def test_won_deal_deleted_later_leaves_the_facts(spark, folder):
    path = f"{folder}/later"
    gone = [*FIRST, ("c", "30.00", True, True, True, "2026-01-02 00:00:00")]
    graph.build(spark, raw(spark, FIRST), path, datetime(2026, 1, 2), buckets=2, checks=False)
    wh = graph.build(spark, raw(spark, gone), path, datetime(2026, 1, 3), buckets=2, checks=False)
    assert wh.read("fct_bookings").count() == wh.read("fct_win_rate").count() == 0


def test_checks_are_stored(wh):
    results = wh.read("quality_results")
    assert results.count() > 90
    assert results.filter("table_name = 'fct_bookings' and check_name = 'unique' and status <> 'pass'").count() == 0


def test_deletes_can_be_ignored(spark, folder):
    wh = graph.Warehouse(spark, folder)
    for rows in (FIRST, SECOND):
        graph.update_staging(wh, opportunities(spark, rows), "Opportunity", deletes="ignore", buckets=2)
    assert rows_of(wh.read("stg_opportunities").select("opportunity_id")) == [("a",), ("b",), ("c",)]


def test_full_refresh_rebuilds(spark, folder):
    wh = graph.Warehouse(spark, folder)
    graph.update_staging(wh, opportunities(spark, FIRST), "Opportunity", buckets=2)
    graph.update_staging(wh, opportunities(spark, FIRST[:1]), "Opportunity", full_refresh=True, buckets=2)
    assert rows_of(wh.read("stg_opportunities").select("opportunity_id")) == [("a",)]


def test_pipeline_can_flag_closed_deals(spark):
    cols = "pipeline_id string, is_active boolean"
    target = spark.createDataFrame([("p", True), ("q", True)], cols)
    now = spark.createDataFrame([("q", True), ("r", True)], cols)
    assert rows_of(graph.pipeline_after(target, now, "flag")) == [("p", False), ("q", True), ("r", True)]
    assert rows_of(graph.pipeline_after(target, now)) == [("q", True), ("r", True)]
    with pytest.raises(ValueError):
        graph.pipeline_after(target, now, "other")


def test_staging_keeps_deleted_users_only(spark):
    users = spark.createDataFrame([("u", True)], "id string, isdeleted boolean")
    assert stage(users, "User").count() == 1
    accounts = spark.createDataFrame([("x", True), ("y", None)], "id string, isdeleted boolean")
    assert rows_of(stage(accounts, "Account").select("account_id")) == [("y",)]
    assert len(UNIQUE_KEYS) == 10


def test_member_type_and_open_flags(spark):
    members = spark.createDataFrame([("1", "l", None), ("2", None, "c"), ("3", None, None)], "id string, leadid string, contactid string")
    got = rows_of(stage(members, "CampaignMember").select("campaign_member_id", "member_type", "person_id"))
    assert got == [("1", "Lead", "l"), ("2", "Contact", "c"), ("3", None, None)]


def test_a_build_releases_shuffle_files_and_packs_its_tables(spark, folder, monkeypatch):
    before, seen, load = spark.conf.get(RELEASE), [], graph.update_staging
    monkeypatch.setattr(graph, "update_staging", lambda wh, *args: (seen.append(wh.spark.conf.get(RELEASE)), load(wh, *args)))
    wh = graph.build(spark, raw(spark, FIRST), folder, datetime(2026, 4, 20), buckets=2, checks=False)
    assert set(seen) == {"true"} and spark.conf.get(RELEASE) == before
    assert wh.read("fct_sales_pipeline").count() == 2
    files = list(Path(folder).glob("*/data/**/part-*"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_an_incremental_build_removes_its_scratch_folders(spark, folder, monkeypatch):
    made, where = [], session.scratch_dir
    monkeypatch.setattr(session, "scratch_dir", lambda *args: made.append(where(*args)) or made[-1])
    graph.build(spark, raw(spark, FIRST), folder, datetime(2026, 4, 20), buckets=2, checks=False)
    wh = graph.build(spark, raw(spark, SECOND), folder, datetime(2026, 4, 21), buckets=2, checks=False)
    assert wh.read("fct_bookings").count() == 2
    names = {Path(p).name.rsplit("-", 1)[0].split("-")[0] for p in made}
    assert {"latest", "deals", "rollup", "touched"} <= names
    assert not [p for p in made if Path(p).exists()]


def test_scratch_frames_go_when_what_they_were_made_into_is_stored(spark):
    with scratch(spark) as store:
        first = store(spark.range(3), "first")
        second = store(first.filter("id > 0"), "second", first)
        folders = [path for _, path in store.held]
        assert len(folders) == 1 and rows_of(second) == [(1,), (2,)]
    assert not Path(folders[0]).exists()


@pytest.mark.parametrize("insert_only", [False, True])
@pytest.mark.parametrize("deleted", [None, [(3,), (6,), (None,)]])
def test_a_merge_in_buckets_sends_rows_once_and_equals_the_joins(spark, insert_only, deleted):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "e"), (5, "f"), (7, "g")], "k long, v string")
    updates = spark.createDataFrame([(2, "B", 1), (4, "D", 1), (None, "N", 1), (5, "E", 1), (6, "F", 1)], "k long, v string, w int")
    deletes = None if deleted is None else spark.createDataFrame(deleted, "k long")
    got = merge_in_buckets(target, updates, "k", {0: 1_000_000, 1: 50, 2: 3}, 3, deletes, insert_only)
    assert rows_of(got.drop("bucket")) == rows_of(merge_upsert(target, updates, "k", deletes=deletes, insert_only=insert_only))
    assert got._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    with pytest.raises(Exception, match="several updates of k"):
        merge_in_buckets(target, updates.union(updates), "k", {0: 9, 1: 9, 2: 9}, 3, deletes, insert_only).collect()


def test_no_more_tables_are_built_at_once_than_cores_can_use(spark):
    cores = spark.sparkContext.defaultParallelism
    assert graph.at_once(spark, 8) == max(1, min(8, cores // 2)) and graph.at_once(spark, 1) == 1
    assert graph.at_once(spark, 1_000) <= cores
