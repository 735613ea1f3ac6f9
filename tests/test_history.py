"""Type-2 history, neighbours within hot keys, as-of joins, exact percentiles."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from revstream.operators.ordered import as_of_join, cut_hot_keys, with_neighbours
from revstream.operators.quantile import exact_percentiles
from revstream.operators.scd import as_of, deliver_versions, live, scd2_build, scd2_snapshot, scd2_step, with_meta_prefix
from revstream.plans import analytics
from revstream.sources import seeds
from revstream.sources.tables import Table

T0 = datetime(2026, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def current(spark, rows):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in rows], "k string, v string, updated_at timestamp_ntz")


def state(history):
    return rows_of(history.select("k", "v", "valid_from", "valid_to"))


def test_snapshot_versions_closes_and_reopens(spark):
    h = scd2_snapshot(None, current(spark, [("a", "1", 0), ("b", "1", 0)]), "k")
    h = scd2_snapshot(h, current(spark, [("a", "2", 3)]), "k", now=day(4))
    assert state(h) == [
        ("a", "1", day(0), day(3)),
        ("a", "2", day(3), None),
        ("b", "1", day(0), day(4)),
    ]
    h = scd2_snapshot(h, current(spark, [("a", "2", 3), ("b", "back", 6)]), "k", now=day(7))
    assert ("b", "back", day(6), None) in state(h) and len(state(h)) == 4


def test_snapshot_ignores_older_and_equal_rows(spark):
    h = scd2_snapshot(None, current(spark, [("a", "1", 5)]), "k")
    same = scd2_snapshot(h, current(spark, [("a", "changed", 5)]), "k", now=day(6))
    older = scd2_snapshot(h, current(spark, [("a", "old", 2)]), "k", now=day(6))
    assert state(same) == state(older) == [("a", "1", day(5), None)]


def test_snapshot_without_invalidation_and_prefix(spark):
    h = scd2_snapshot(None, current(spark, [("a", "1", 0)]), "k")
    h = scd2_snapshot(h, current(spark, []), "k", invalidate=False)
    assert state(h) == [("a", "1", day(0), None)]
    names = with_meta_prefix(h, "x_").columns
    assert names[-4:] == ["x_scd_id", "x_valid_from", "x_valid_to", "x_updated_at"]
    with pytest.raises(ValueError):
        scd2_step(h, current(spark, []), "k")


def test_snapshot_table_keeps_closed_versions(spark, folder):
    table = Table(spark, folder)
    for i, rows in enumerate([[("a", "1", 0), ("b", "1", 0)], [("a", "2", 1), ("b", "1", 0)], [("a", "3", 2)]]):
        table.snapshot(scd2_step(table.open_versions(), current(spark, rows), "k", now=day(i + 1)))
    assert state(table.read()) == [
        ("a", "1", day(0), day(1)),
        ("a", "2", day(1), day(2)),
        ("a", "3", day(2), None),
        ("b", "1", day(0), day(3)),
    ]
    assert state(table.open_versions()) == [("a", "3", day(2), None)]
    assert table.head().row_count == 4


@pytest.mark.parametrize("min_rows", [1, 1_000_000])
def test_build_gives_contiguous_disjoint_intervals(spark, min_rows):
    rng = random.Random(3)
    rows = [(rng.choice("aaaaaabc"), str(i), rng.randrange(400)) for i in range(600)]
    h = scd2_build(current(spark, rows), "k", order=[F.col("v")], min_rows=min_rows)
    by_key = {}
    for k, start, end in sorted((r.k, r.valid_from, r.valid_to) for r in h.select("k", "valid_from", "valid_to").sort("k", "valid_from").collect() if r.valid_to):
        by_key.setdefault(k, []).append((start, end))
    for spans in by_key.values():
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert h.filter("valid_to is null").count() == 3
    assert h.count() == len({(k, d) for k, _, d in rows})


def test_as_of_is_half_open(spark):
    h = scd2_build(current(spark, [("a", "1", 0), ("a", "2", 5)]), "k")
    assert [r.v for r in as_of(h, day(5)).collect()] == ["2"]
    assert [r.v for r in as_of(h, day(4)).collect()] == ["1"]
    assert as_of(h, day(-1)).count() == 0


@pytest.mark.parametrize("min_rows", [2, 1_000_000])
def test_neighbours_equal_a_plain_window(spark, min_rows):
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 8 + ["b", "c", None]), day(rng.randrange(300)), i, rng.choice([None, "x", "y"])) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i int, v string").cache()
    got = with_neighbours(df, "k", "ts", {"next_v": "v"}, {"prev_i": "i", "prev_v": "v"}, ties=("i",), min_rows=min_rows)
    w = Window.partitionBy("k").orderBy("ts", "i")
    want = df.withColumns({"next_v": F.lead("v").over(w), "prev_i": F.lag("i").over(w), "prev_v": F.lag("v").over(w)})
    assert rows_of(got) == rows_of(want)
    cut = cut_hot_keys(df, "k", "ts", min_rows)
    if min_rows == 2:
        assert cut.filter("k = 'hot'").select("_range").distinct().count() > 20
    else:
        assert cut is None


@pytest.mark.parametrize("min_rows", [2, 1_000_000])
def test_as_of_join_equals_brute_force(spark, min_rows):
    rng = random.Random(11)
    keys = ["hot"] * 8 + ["b", "c"]
    versions = {}
    for _ in range(300):
        versions[(rng.choice(keys), day(rng.randrange(200)))] = str(rng.randrange(99))
    hist = []
    for k in set(keys):
        starts = sorted(t for kk, t in versions if kk == k)
        for i, t in enumerate(starts):
            # Some versions end early, leaving a gap before the next.
            end = starts[i + 1] if i + 1 < len(starts) else None
            if end and rng.random() < 0.3:
                end = t + timedelta(hours=5)
            hist.append((k, versions[(k, t)], t, end))
    facts = [(i, rng.choice([*keys, None, "none"]), rng.choice([None, *[day(rng.randrange(-5, 210)) + timedelta(hours=rng.randrange(9))] * 9])) for i in range(900)]
    h = spark.createDataFrame(hist, "k string, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame(facts, "i int, k string, ts timestamp_ntz")
    got = {r.i: r.v_then for r in as_of_join(f, h, "k", "ts", {"v_then": "v"}, min_rows=min_rows).collect()}
    want = {}
    for i, k, ts in facts:
        hits = [v for kk, v, a, b in hist if kk == k and ts is not None and a <= ts and (b is None or ts < b)]
        want[i] = hits[0] if hits else None
    assert got == want and any(v is not None for v in want.values())


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_exact_percentiles_equal_numpy(spark, accuracy):
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.gamma(2, 50, 5000).round(3)] + [("small", 1.5), ("small", 4.0), ("one", 9.0)]
    rows += [("tied", 7.0)] * 900 + [("tied", float(v)) for v in range(100)] + [(None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows + [("none", None)], "g string, x double")
    found = exact_percentiles(df, "g", "x", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}, accuracy)
    got = {r.g: (r.p50, r.p95, r.p0, r.p100) for r in found.collect()}
    assert set(got) == {"hot", "small", "one", "tied", None}
    for g, values in got.items():
        data = [x for gg, x in rows if gg == g]
        assert values == pytest.approx([np.percentile(data, p) for p in (50, 95, 0, 100)], abs=1e-9)


def test_returning_key_does_not_overlap_its_closed_version(spark, folder):
    table = Table(spark, folder)
    h = None
    for i, rows in enumerate([[("a", "1", 0)], [("b", "1", 1)], [("a", "1", 0), ("b", "1", 1)], [("a", "2", 9), ("b", "1", 1)]]):
        h = scd2_snapshot(h, current(spark, rows), "k", now=day(i + 1))
        table.snapshot(scd2_step(table.open_versions(), current(spark, rows), "k", now=day(i + 1), closed=table.closed_versions()))
    want = [("a", "1", day(0), day(2)), ("a", "1", day(2), day(9)), ("a", "2", day(9), None), ("b", "1", day(1), None)]
    assert state(h) == state(table.read()) == want
    assert h.select("scd_id").distinct().count() == 4
    assert as_of(h, day(1)).filter("k = 'a'").count() == 1


def test_snapshot_with_new_and_lost_columns(spark):
    h = scd2_snapshot(None, current(spark, [("a", "1", 0)]).withColumn("old", F.lit(1)), "k")
    h = scd2_snapshot(h, current(spark, [("a", "2", 1)]).withColumn("new", F.lit("x")), "k", now=day(2))
    assert rows_of(h.select("v", "old", "new")) == [("1", 1, None), ("2", None, "x")]
    h = scd2_snapshot(h, current(spark, [("a", "3", 3)]).withColumn("new", F.lit("y")), "k", now=day(4))
    assert rows_of(h.select("v", "old", "new")) == [("1", 1, None), ("2", None, "x"), ("3", None, "y")]


@pytest.mark.parametrize("min_rows", [2, 10**9])
def test_build_closes_deleted_keys(spark, min_rows):
    rows = [("a", "1", 0, False), ("a", "1", 2, True), ("b", "1", 0, None), ("c", "1", 0, False), ("c", "1", 1, True), ("c", "2", 5, False)]
    versions = spark.createDataFrame([(k, v, day(d), x) for k, v, d, x in rows], "k string, v string, updated_at timestamp_ntz, gone boolean")
    h = scd2_build(versions, "k", deleted="gone", min_rows=min_rows)
    assert "gone" not in h.columns
    assert state(h) == [("a", "1", day(0), day(2)), ("b", "1", day(0), None), ("c", "1", day(0), day(1)), ("c", "2", day(5), None)]


def test_a_key_with_one_time_is_spread(spark):
    """Cuts fall between rows of one timestamp; ties and then a digest order them, and neighbours follow that order."""
    rows = [("hot", day(1), i % 50, i) for i in range(400)] + [("hot", day(0), 0, -1), ("cold", day(1), 0, 0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, tie int, n int").repartition(5)
    cut = cut_hot_keys(df, "k", "ts", 40, ("tie",))
    sizes = [r["count"] for r in cut.filter("k = 'hot'").groupBy("_range").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 120 and sum(sizes) == 401
    assert cut.filter("k = 'cold'").select("_range").collect() == [(None,)]
    near = with_neighbours(df, "k", "ts", {"after": "n"}, {"before": "n"}, ties=("tie",), min_rows=40).filter("k = 'hot'").collect()
    after = {r.n: r.after for r in near}
    chain, at = [-1], -1  # the successors lead through all rows once, in order
    while after[at] is not None:
        at = after[at]
        chain.append(at)
    assert sorted(chain) == list(range(-1, 400)) and [n % 50 for n in chain[1:]] == sorted(n % 50 for n in range(400))
    assert {r.n: r.before for r in near} == {b: a for a, b in zip([None, *chain], chain)}
    # A count from elsewhere only decides whether to look closer.
    assert cut_hot_keys(df, "k", "ts", 40, counted=spark.createDataFrame([("x",)] * 50, "k string")) is not None
    assert cut_hot_keys(df, "k", "ts", 1_000) is None


def test_neighbours_of_a_hot_null_key(spark):
    df = spark.createDataFrame([(None if i % 3 else "k", day(i), i) for i in range(60)], "k string, ts timestamp_ntz, n int")
    cut = cut_hot_keys(df, "k", "ts", 5)
    assert cut.filter("k is null and _range is null").count() == 0 and cut.select("k", "_range").distinct().count() > 8
    near = lambda rows: rows_of(with_neighbours(df, "k", "ts", {"after": "n"}, {"before": "n"}, min_rows=rows))
    assert near(5) == near(10**9)


def test_stage_regression_sees_unknown_stages(spark):
    rows = [("a", "Closed Won", day(0)), ("a", "Unheard Of", day(1)), ("a", "Prospecting", day(2)), ("b", "Negotiation/Review", day(0)), ("b", "Prospecting", day(1))]
    h = spark.createDataFrame(rows, "k string, stage_name string, valid_from timestamp_ntz")
    found = analytics.stage_regression(h, seeds.stage_order(spark), "k")
    assert rows_of(found) == [("b", "Negotiation/Review", "Prospecting", day(1))]


def test_stage_regression_across_range_cuts(spark):
    rng = random.Random(2)
    names = [row[0] for row in seeds.STAGES]
    rows = [("hot" if i % 3 else f"k{i}", rng.choice(names), day(i)) for i in range(300)]
    h = spark.createDataFrame(rows, "k string, stage_name string, valid_from timestamp_ntz")
    stages = seeds.stage_order(spark)
    cut = analytics.stage_regression(h, stages, "k", min_rows=2)
    assert rows_of(cut) == rows_of(analytics.stage_regression(h, stages, "k")) and cut.count() > 50


def test_linear_attribution_adds_up_to_the_booked_amount(spark):
    demand = spark.createDataFrame(
        [(i, i % 4, 10 + i % 3, day(i)) for i in range(40)],
        "campaign_member_id int, campaign_id int, converted_opportunity_id_attr int, member_created_at timestamp_ntz",
    )
    bookings = spark.createDataFrame([(10, "100.00"), (11, "55.55"), (12, "0.01")], "opportunity_id int, a string").selectExpr(
        "opportunity_id", "cast(a as decimal(38,2)) as booking_amount"
    )
    total = analytics.attribution(demand, bookings, "linear").agg(F.sum("attributed_amount")).first()[0]
    assert float(total) == pytest.approx(155.56, abs=1e-4)
    for model in ("first", "last"):
        assert float(analytics.attribution(demand, bookings, model).agg(F.sum("attributed_amount")).first()[0]) == 155.56
    with pytest.raises(ValueError):
        analytics.attribution(demand, bookings, "other")


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_delivered_in_any_order(spark, folder, seed):
    """Deliveries in shuffled order, some twice, end as the whole log does; deletes that follow each other stay known."""
    r = random.Random(seed)
    ddl = "id string, v int, updated_at timestamp_ntz, gone boolean"
    log = [(f"k{r.randrange(12)}", i, datetime(2026, 1, 1) + timedelta(hours=h), r.random() < 0.3) for i, h in enumerate(r.sample(range(500), 90))]
    log += [(None, 1_000 + i, datetime(2026, 2, 1 + i), False) for i in range(3)]
    r.shuffle(log)
    table = Table(spark, folder)
    for i in range(0, len(log), 25):
        deliver_versions(table, spark.createDataFrame(log[i : i + 25] + r.sample(log[: i + 25], 5), ddl), "id", buckets=8, min_rows=4)
    want = scd2_build(spark.createDataFrame(log, ddl), "id", deleted="gone")
    got = live(table.read(), "gone")
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    for key, v, at, gone in log:  # and against the log itself
        later = min((t for k, _, t, _ in log if k == key and t > at), default=None)
        rows = got.filter(F.col("v") == v).collect() if v % 9 == 0 else None
        if rows is not None:
            assert [(x["valid_from"], x["valid_to"]) for x in rows] == ([] if gone else [(at, later)])


def test_a_late_version_rewrites_only_its_keys_buckets(spark, folder):
    table, ddl = Table(spark, folder), "id string, v int, updated_at timestamp_ntz"
    day = lambda n: datetime(2026, 1, n)
    deliver_versions(table, spark.createDataFrame([(f"k{i}", 0, day(10)) for i in range(100)], ddl), "id", buckets=16)
    before = set(table.head().parts)
    deliver_versions(table, spark.createDataFrame([("k3", 1, day(5)), ("k3", 2, day(20))], ddl), "id")
    assert len(before - set(table.head().parts)) == 1
    assert rows_of(table.read().filter("id = 'k3'").select("v", "valid_from", "valid_to")) == [
        (0, day(10), day(20)), (1, day(5), day(10)), (2, day(20), None)
    ]
    version = table.head().version
    deliver_versions(table, spark.createDataFrame([], ddl), "id")
    assert table.head().version == version
    wider = spark.createDataFrame([("k4", 9, day(1), "x")], ddl + ", region string")
    deliver_versions(table, wider, "id")
    assert rows_of(table.read().filter("id = 'k4'").select("v", "region", "valid_to")) == [(0, None, None), (9, "x", day(10))]
