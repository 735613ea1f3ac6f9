"""Watermarks, extract runs, upserts and stored tables."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from revstream.operators.dedup import dedup_latest
from revstream.operators.extract import extract_objects, run_summary
from revstream.operators.incremental import (
    DEFAULT_WATERMARK,
    apply_lookback,
    as_utc,
    delete_flag,
    exclude_deleted,
    incremental_filter,
    loaded_at,
)
from revstream.operators.upsert import merge_upsert
from revstream.operators.watermark import WatermarkStore
from revstream.sources.tables import Table, compact_dedup

UTC = timezone.utc


@pytest.fixture
def store(spark, folder):
    return WatermarkStore(spark, folder)


def test_watermark_default_roundtrip_and_naive(store):
    assert store.get("Account") == DEFAULT_WATERMARK == datetime(2020, 1, 1, tzinfo=UTC)
    store.set("Account", datetime(2026, 1, 1, tzinfo=UTC))
    store.set("Account", datetime(2026, 1, 1, tzinfo=UTC))
    store.set("Lead", "2025-06-01T00:00:00")
    assert store.get("Account") == datetime(2026, 1, 1, tzinfo=UTC)
    assert store.get("Lead") == datetime(2025, 6, 1, tzinfo=UTC)
    everything = {r["object"]: as_utc(r["watermark"]) for r in store.get_all().collect()}
    assert len(everything) == 10 and everything["Lead"].year == 2025 and everything["User"] == DEFAULT_WATERMARK


def test_twelve_unknown_objects_get_the_default(store):
    names = [f"Custom{i}__c" for i in range(12)]
    assert {r["watermark"] for r in store.get_all(names).collect()} == {DEFAULT_WATERMARK.isoformat()}


@pytest.mark.parametrize(
    "at, expected",
    [
        (datetime(2026, 4, 20, 12, tzinfo=UTC), datetime(2026, 4, 20, 11, 30, tzinfo=UTC)),
        (datetime(2026, 4, 20, 0, 15, tzinfo=UTC), datetime(2026, 4, 19, 23, 45, tzinfo=UTC)),
    ],
)
def test_lookback(at, expected):
    assert apply_lookback(at, 30) == expected


def source(spark, n):
    return spark.range(n).selectExpr("id", "timestamp_ntz'2026-01-01 00:00:00' as systemmodstamp")


def run(spark, folder, sources, **kw):
    store = WatermarkStore(spark, f"{folder}/marks")
    log = extract_objects(spark, sources, store, f"{folder}/land", run_ts=datetime(2026, 4, 20, tzinfo=UTC), backoff=(0, 0), **kw)
    return store, {r["object"]: r for r in log.collect()}, log


def test_dry_run_writes_nothing(spark, folder):
    store, results, _ = run(spark, folder, {"Account": lambda: source(spark, 3)}, dry_run=True)
    assert results["Account"].status == "dry_run" and results["Account"].watermark_used == "2019-12-31T23:30:00+00:00"
    assert not Path(f"{folder}/land").exists() and store.get("Account") == DEFAULT_WATERMARK


def test_extract_run_packs_its_files(spark, folder):
    _, results, _ = run(spark, folder, {"Account": lambda: source(spark, 500)})
    assert results["Account"].records == 500
    files = list(Path(folder, "land").rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert spark.read.text(f"{folder}/land").count() == 500


def test_failed_watermark_lookup_is_one_objects_failure(spark, folder, monkeypatch):
    lookup = WatermarkStore.get

    def get(self, obj):
        if obj == "Account":
            raise ValueError("no watermark")
        return lookup(self, obj)

    monkeypatch.setattr(WatermarkStore, "get", get)
    store, results, _ = run(spark, folder, {"Account": lambda: source(spark, 3), "Contact": lambda: source(spark, 2)})
    assert results["Account"].status == "error" and results["Account"].watermark_used is None
    assert results["Contact"].status == "success"
    monkeypatch.undo()
    assert store.get("Account") == DEFAULT_WATERMARK and store.get("Contact") == datetime(2026, 4, 20, tzinfo=UTC)


def test_one_failure_does_not_stop_the_others(spark, folder):
    calls = []

    def broken():
        calls.append(1)
        raise RuntimeError("remote is down")

    def bad_query():
        raise ValueError("no such field")

    store, results, log = run(
        spark, folder, {"Account": lambda: source(spark, 3), "Lead": broken, "Contact": bad_query, "User": lambda: source(spark, 2)}
    )
    assert (results["Account"].status, results["Account"].records) == ("success", 3)
    assert (results["Lead"].status, results["Lead"].attempts, len(calls)) == ("error", 3, 3)
    assert (results["Contact"].status, results["Contact"].attempts) == ("error", 1)
    assert store.get("Account") == store.get("User") == datetime(2026, 4, 20, tzinfo=UTC)
    assert store.get("Lead") == DEFAULT_WATERMARK
    total = run_summary(log).first()
    assert (total.objects_run, total.total_records, total.failures) == (4, 5, "Contact,Lead")


def test_backfill_leaves_watermarks_alone(spark, folder):
    kept = Table(spark, f"{folder}/log")
    store, results, _ = run(spark, folder, {"Account": lambda: source(spark, 3)}, backfill_start="2026-02-01T00:00:00Z", log_table=kept)
    assert [r["object"] for r in kept.read().collect()] == ["Account"]
    assert results["Account"].records == 0 and results["Account"].watermark_used == "2026-02-01T00:00:00+00:00"
    assert store.get("Account") == DEFAULT_WATERMARK


def frame(spark, rows, schema="id int, v string, ts int"):
    return spark.createDataFrame(rows, schema)


def test_merge_updates_inserts_and_is_idempotent(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1)])
    updates = frame(spark, [(2, "B", 2), (3, "C", 2)])
    once = merge_upsert(target, updates, "id")
    assert rows_of(once) == [(1, "a", 1), (2, "B", 2), (3, "C", 2)]
    assert rows_of(merge_upsert(once, updates, "id")) == rows_of(once)
    assert rows_of(merge_upsert(None, updates, "id")) == rows_of(updates)


def test_merge_options(spark):
    target = frame(spark, [(1, "a", 5), (2, "b", 1), (4, "d", 1)])
    updates = frame(spark, [(1, "late", 3), (2, "B", 2)])
    assert rows_of(merge_upsert(target, updates, "id", newer="ts")) == [(1, "a", 5), (2, "B", 2), (4, "d", 1)]
    assert rows_of(merge_upsert(target, updates, "id", deletes=target.filter("id = 4"))) == [(1, "late", 3), (2, "B", 2)]
    assert rows_of(merge_upsert(target, frame(spark, [(1, "x", 9), (7, "y", 9)]), "id", insert_only=True)) == [
        (1, "a", 5), (2, "b", 1), (4, "d", 1), (7, "y", 9),
    ]


def test_insert_only_never_replaces(spark):
    target = frame(spark, [(1, "a", 5), (2, "b", 1)])
    updates = frame(spark, [(1, "x", 9), (2, "y", 9), (7, "old", 1), (7, "new", 2)])
    assert rows_of(merge_upsert(target, updates, "id", newer="ts", insert_only=True)) == [(1, "a", 5), (2, "b", 1), (7, "new", 2)]
    assert rows_of(merge_upsert(None, updates, "id", newer="ts", insert_only=True)) == [(1, "x", 9), (2, "y", 9), (7, "new", 2)]


def test_updates_at_one_time_end_alike_in_any_order(spark):
    rows = [(1, v, 3) for v in "abcdefgh"] + [(1, None, 3)]
    kept = {tuple(rows_of(merge_upsert(t, frame(spark, rows[i:] + rows[:i]).repartition(3), "id", newer="ts"))) for i in range(0, 9, 2) for t in (None, frame(spark, [(1, "z", 3)]))}
    assert len(kept) == 1
    # A row with a column that has no order can be merged too.
    odd = spark.sql("select 1 id, 2 ts, map('a', 1) m, parse_json('{}') v")
    assert merge_upsert(odd, odd, "id", newer="ts").count() == 1


def test_null_keys_do_not_count_as_one_key(spark):
    updates = frame(spark, [(None, "a", 1), (None, "b", 1), (1, "c", 1)])
    assert merge_upsert(None, updates, "id").count() == 3


def test_table_upsert_rewrites_only_touched_buckets(spark, folder):
    table = Table(spark, folder)
    assert table.read() is None
    table.upsert(spark.range(1000).selectExpr("cast(id as int) id", "'a' v", "1 ts"), "id", buckets=16)
    before = set(table.head().parts)
    table.upsert(frame(spark, [(5, "z", 2)]), "id")
    after = set(table.head().parts)
    assert len(before) == len(after) == 16 and len(before & after) == 15
    assert table.head().row_count == 1000 == table.read().count()
    assert rows_of(table.read().filter("id = 5")) == [(5, "z", 2)]


def test_table_delete_and_schema_change(spark, folder):
    table = Table(spark, folder)
    table.upsert(frame(spark, [(1, "a", 1), (2, "b", 1)]), "id", buckets=4)
    table.upsert(spark.createDataFrame([(3, 7, "new")], "id int, ts int, w string"), "id", deletes=frame(spark, [(1, "", 0)]))
    assert table.read().columns == ["id", "ts", "w"]
    assert rows_of(table.read()) == [(2, 1, None), (3, 7, "new")]
    table.upsert(frame(spark, [], "id int, ts int, w string"), "id", deletes=table.read())
    assert table.read().count() == 0


def test_unfinished_write_is_not_seen(spark, folder):
    table = Table(spark, folder)
    table.overwrite(frame(spark, [(1, "a", 1)]))
    frame(spark, [(9, "lost", 1)]).write.parquet(f"{folder}/data/v2-crashed")
    assert rows_of(table.read()) == [(1, "a", 1)]
    table.append(frame(spark, [(2, "b", 1)]))
    assert rows_of(table.read()) == [(1, "a", 1), (2, "b", 1)]
    assert [r.operation for r in table.commits().orderBy("version").collect()] == ["overwrite", "append"]


def test_compact_dedup_and_dedup_properties(spark, folder):
    rows = [(1, "old", 1), (1, "new", 2), (2, "only", None), (2, "dated", 1)]
    df = frame(spark, rows)
    order = [F.col("ts").desc_nulls_last()]
    once = dedup_latest(df, "id", order)
    assert rows_of(once) == [(1, "new", 2), (2, "dated", 1)] == rows_of(dedup_latest(once, "id", order))
    table = Table(spark, folder)
    table.append(df)
    compact_dedup(table, "id", order)
    assert rows_of(table.read()) == rows_of(once)


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = frame(spark, [(1, "a", 1)])
    plan = dedup_latest(df, "id", [F.desc("ts")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial below the exchange, final above


def test_incremental_filter_edges(spark):
    df = spark.createDataFrame([(i, datetime(2026, 1, i)) for i in range(1, 11)], "id int, systemmodstamp timestamp_ntz")
    target = spark.createDataFrame([(datetime(2026, 1, 8),)], "updated_at timestamp_ntz")
    assert sorted(r.id for r in incremental_filter(df, target).collect()) == [5, 6, 7, 8, 9, 10]
    assert incremental_filter(df, target.limit(0)).count() == incremental_filter(df, None).count() == 10
    own = incremental_filter(df, df, "systemmodstamp", "systemmodstamp", days=1)
    assert sorted(r.id for r in own.collect()) == [9, 10]


def test_source_switch(spark):
    df = spark.createDataFrame([(1, True, None), (2, None, True), (3, False, False)], "id int, isdeleted boolean, _fivetran_deleted boolean")
    assert [r.id for r in exclude_deleted(df).collect()] == [2, 3]
    assert [r.id for r in exclude_deleted(df, "connector").collect()] == [1, 3]
    assert loaded_at() == "_load_timestamp" and loaded_at("connector") == "_fivetran_synced"
    with pytest.raises(ValueError):
        delete_flag(df, "other")


def test_apply_lookback_is_plain_arithmetic():
    now = datetime(2026, 1, 1, tzinfo=UTC)
    assert now - apply_lookback(now) == timedelta(minutes=30)


def test_first_upsert_keeps_one_row_per_key(spark):
    from revstream.operators.upsert import merge_upsert

    updates = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "x")], "k int, t int, v string")
    assert sorted(tuple(r) for r in merge_upsert(None, updates, "k", newer="t").collect()) == [(1, 3, "c"), (2, 1, "x")]


def test_an_old_file_is_loaded_after_newer_ones(spark, folder):
    import os
    import time

    from revstream.sources.landing import object_path
    from revstream.streaming.ingest import landing_stream

    at = f"{object_path(folder, 'Account')}/date=2026-01-01"
    os.makedirs(at)
    for i, days in enumerate((0, 0, 9)):
        with open(f"{at}/{i}.json", "w") as f:
            f.write('{"Id": "%d"}\n' % i)
        os.utime(f"{at}/{i}.json", (time.time() - days * 86_400,) * 2)
        query = landing_stream(spark, folder, "Account").writeStream.format("parquet").option("checkpointLocation", f"{folder}/check")
        query.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_columns_dropped_added_again_and_retyped(spark, folder):
    table = Table(spark, f"{folder}/columns")
    table.upsert(spark.range(20).selectExpr("cast(id as int) id", "1 ts", "'old' v", "cast(id as int) n"), "id", buckets=8)
    table.upsert(spark.sql("select 0 id, 2 ts, 5 n"), "id")  # v is dropped
    table.upsert(spark.sql("select 1 id, 3 ts, 'new' v, 'seven' n"), "id")  # v comes again, n becomes text
    got = {r.id: (r.v, r.n) for r in table.read().collect()}
    assert got == {0: (None, "5"), 1: ("new", "seven")} | {i: (None, str(i)) for i in range(2, 20)}
    table.upsert(spark.sql("select 2 id, 4 ts, 'newer' v, 'x' n"), "id", newer="ts")
    got = {r.id: (r.v, r.n) for r in table.read().collect()}
    assert got == {0: (None, "5"), 1: ("new", "seven"), 2: ("newer", "x")} | {i: (None, str(i)) for i in range(3, 20)}


def test_two_updates_of_a_key_need_an_order(spark):
    target, twice = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "b", 2), (1, "c", 3)])
    assert rows_of(merge_upsert(target, twice, "id", newer="ts")) == [(1, "c", 3)]
    for stored in (None, target):
        with pytest.raises(Exception, match="several updates of id 1"):
            merge_upsert(stored, twice, "id").collect()
