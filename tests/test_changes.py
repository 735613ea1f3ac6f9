"""Changes carried into facts: which rows a run touches, what it rewrites, and runs that die half way."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from revstream.catalog import OBJECTS
from revstream.operators.upsert import bucket_of
from revstream.plans import build as graph
from revstream.plans import changes
from revstream.plans.staging import conform

MEMBER = "campaign_member_id string, campaign_id string, lead_id string, contact_id string"


def test_changed_rows_keeps_what_differs(spark):
    target = spark.createDataFrame([("m1", "c1", "l", None), ("m2", "c1", None, None), ("m3", "c2", "x", "y"), ("m4", "c2", None, "z")], MEMBER)
    updates = spark.createDataFrame([("m1", "c1", None, "l"), ("m2", "c1", None, None), ("m5", None, None, None), ("m3", "c1", "x", "y")], MEMBER)
    gone = spark.createDataFrame([("m4",), ("m9",)], "campaign_member_id string")
    # m1 moved a value between two nullable columns, m2 is the same, m3 moved to c1, m4 is deleted, m9 was never there.
    want = [("m1", "c1"), ("m3", "c1"), ("m3", "c2"), ("m4", "c2"), ("m4", None), ("m5", None)]
    assert rows_of(changes.changed_rows(target, updates, gone, "campaign_member_id", "campaign_id")) == sorted(want, key=repr)
    assert rows_of(changes.changed_rows(target, updates, None, "campaign_member_id")) == [("m1",), ("m3",), ("m5",)]
    wider = updates.withColumn("region", F.lit(1))
    assert rows_of(changes.changed_rows(target, wider, None, "campaign_member_id")) == [("m1",), ("m2",), ("m3",), ("m5",)]


@pytest.fixture
def none(spark):
    key = {"Account": "account_id", "User": "user_id", "Campaign": "campaign_id", "Lead": "lead_id", "Contact": "contact_id"}
    empty = {o: spark.createDataFrame([], f"{k} string") for o, k in key.items()}
    return empty | {
        "Opportunity": spark.createDataFrame([], "opportunity_id string, campaign_id string"),
        "OpportunityLineItem": spark.createDataFrame([], "opportunity_line_item_id string, opportunity_id string"),
        "CampaignMember": spark.createDataFrame([], "campaign_member_id string, campaign_id string"),
    }


DEALS = "opportunity_id string, account_id string, owner_id string, campaign_id string, is_closed boolean, close_date date"


def test_deals_are_touched_through_every_lookup(spark, none):
    day = datetime(2026, 1, 1)
    deals = spark.createDataFrame(
        [("d1", "a1", "u1", "c1", True, day), ("d2", "a2", "u2", "c2", True, day), ("d3", "a2", "u3", None, True, None), ("d4", None, None, None, False, day), ("d5", "a9", "u9", "c9", None, day)],
        DEALS,
    )
    touched = lambda day_changed=False, **found: [r[0] for r in rows_of(changes.touched_opportunities(deals, none | found, day_changed))]
    one = lambda ddl, *values: spark.createDataFrame([values], ddl)
    assert touched() == []
    assert touched(Account=one("account_id string", "a2")) == ["d2", "d3"]
    assert touched(User=one("user_id string", "u1")) == ["d1"]
    assert touched(Campaign=one("campaign_id string", "c2")) == ["d2"]
    assert touched(OpportunityLineItem=one("opportunity_line_item_id string, opportunity_id string", "i", "d4")) == ["d4"]
    assert touched(Opportunity=one("opportunity_id string, campaign_id string", "gone", None)) == ["gone"]
    assert touched(day_changed=True) == ["d3", "d4", "d5"]  # measures count to today


def test_members_and_campaigns_are_touched(spark, none):
    members = spark.createDataFrame([("m1", "c1", "l1", None), ("m2", "c1", "l2", None), ("m3", "c2", None, "p1")], MEMBER)
    leads = spark.createDataFrame([("l1", "d1"), ("l2", None)], "lead_id string, converted_opportunity_id string")
    touched = lambda **found: [r[0] for r in rows_of(changes.touched_members(members, leads, none | found))]
    one = lambda ddl, *values: spark.createDataFrame([values], ddl)
    deal = one("opportunity_id string, campaign_id string", "d1", "c7")
    assert touched(Opportunity=deal) == ["m1"]
    assert touched(Lead=one("lead_id string", "l2")) == ["m2"]
    assert touched(Contact=one("contact_id string", "p1")) == ["m3"]
    assert touched(Campaign=one("campaign_id string", "c1")) == ["m1", "m2"]
    moved = spark.createDataFrame([("m3", "c1"), ("m3", "c2")], "campaign_member_id string, campaign_id string")
    assert touched(CampaignMember=moved) == ["m3"]
    assert rows_of(changes.touched_campaigns(none | {"CampaignMember": moved, "Opportunity": deal})) == [("c1",), ("c2",), ("c7",)]


BUCKETS = 32
DAY = "2026-01-01 00:00:00"


def raw(spark, industry="Old", deals=(), moved=False):
    """Forty accounts with five won deals each; account 7 has ``industry``, deals in ``deals`` are deleted."""
    stamp = lambda late: "2026-01-02 00:00:00" if late else DAY
    accounts = [(f"a{i}", industry if i == 7 else "Same", stamp(i == 7 and industry != "Old")) for i in range(40)]
    won = [(f"d{i}", f"a{i % 40}", True, True, i in deals, "2025-06-01", stamp(i in deals)) for i in range(200)]
    items = [("i1", "d2" if moved else "d1", "5.00", stamp(moved)), ("i2", "d1", "7.00", DAY)]
    typed = lambda rows, ddl: spark.createDataFrame(rows, ddl).withColumn("systemmodstamp", F.col("systemmodstamp").cast("timestamp_ntz"))
    out = {o: spark.createDataFrame([], ", ".join(f"{n} {k}" for n, k in OBJECTS[o].columns.items())) for o in OBJECTS}
    deal_rows = typed(won, "id string, accountid string, isclosed boolean, iswon boolean, isdeleted boolean, closedate string, systemmodstamp string")
    out["Account"] = conform(typed(accounts, "id string, industry string, systemmodstamp string"), "Account")
    out["Opportunity"] = conform(deal_rows.withColumn("closedate", F.col("closedate").cast("date")), "Opportunity")
    line = typed(items, "id string, opportunityid string, totalprice string, systemmodstamp string")
    out["OpportunityLineItem"] = conform(line.withColumn("totalprice", F.col("totalprice").cast("decimal(38,2)")), "OpportunityLineItem")
    return out


def facts_of(wh):
    return {n: rows_of(wh.read(n).drop("built_at")) for n in (*graph.FACTS, graph.ENRICHED)}


@pytest.fixture(scope="module")
def whole(spark):
    """Facts of a full load of the final rows."""
    from revstream.session import scratch_dir

    last = raw(spark, "New", deals=(3,), moved=True)
    return facts_of(graph.build(spark, last, scratch_dir(spark, "full"), datetime(2026, 1, 3), buckets=BUCKETS, checks=False))


def test_only_touched_buckets_are_rewritten(spark, folder, whole):
    wh = graph.build(spark, raw(spark), folder, datetime(2026, 1, 2), buckets=BUCKETS, checks=False)
    before = {n: set(wh.table(n).head().parts) for n in graph.FACTS}
    last = raw(spark, "New", deals=(3,), moved=True)
    graph.build(spark, last, folder, datetime(2026, 1, 3), buckets=BUCKETS, checks=False)
    assert facts_of(wh) == whole
    # Five deals of the changed account, the deleted deal and the two deals the line item left and joined.
    ids = [f"d{i}" for i in range(7, 200, 40)] + ["d3", "d1", "d2"]
    hit = spark.createDataFrame([(graph_key(i),) for i in ids], "booking_id string").select(bucket_of("booking_id", BUCKETS)).distinct()
    kept = set(wh.table("fct_bookings").head().parts) & before["fct_bookings"]
    assert {int(p.rsplit("=", 1)[1]) for p in before["fct_bookings"] - kept} == {r[0] for r in hit.collect()}
    assert len(kept) > BUCKETS / 2
    assert set(wh.table("fct_demand_generation").head().parts) == before["fct_demand_generation"]
    # A run without changes commits to no fact.
    versions = {n: wh.table(n).head().version for n in graph.FACTS}
    graph.build(spark, last, folder, datetime(2026, 1, 3, 12), buckets=BUCKETS, checks=False)
    assert {n: wh.table(n).head().version for n in graph.FACTS} == versions


def graph_key(value):
    import hashlib

    return hashlib.md5(value.encode()).hexdigest()


def test_changes_of_a_run_that_died_are_not_lost(spark, folder, whole, monkeypatch):
    graph.build(spark, raw(spark), folder, datetime(2026, 1, 2), buckets=BUCKETS, checks=False)
    last = raw(spark, "New", deals=(3,), moved=True)
    with monkeypatch.context() as m:
        m.setattr(graph, "merge_facts", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            graph.build(spark, last, folder, datetime(2026, 1, 3), buckets=BUCKETS, checks=False)
    wh = graph.build(spark, last, folder, datetime(2026, 1, 3), buckets=BUCKETS, checks=False)  # staging has nothing new now
    assert facts_of(wh) == whole
    assert all(graph.pending(wh, o).read() is None or graph.pending(wh, o).read().isEmpty() for o in changes.PARENTS)


def test_a_full_run_that_died_is_repeated(spark, folder, whole, monkeypatch):
    graph.build(spark, raw(spark), folder, datetime(2026, 1, 2), buckets=BUCKETS, checks=False)
    last = raw(spark, "New", deals=(3,), moved=True)
    with monkeypatch.context() as m:
        m.setattr(graph, "rewrite_facts", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            graph.build(spark, last, folder, datetime(2026, 1, 3), full_refresh=True, buckets=BUCKETS, checks=False)
    assert facts_of(graph.build(spark, last, folder, datetime(2026, 1, 3), buckets=BUCKETS, checks=False)) == whole


def test_flagged_and_ledger_rows_stay(spark, folder):
    """Deals that leave the pipeline can be kept as inactive, and booked rows as they were."""
    start = raw(spark)
    start["Opportunity"] = start["Opportunity"].withColumns({"isclosed": F.col("id") != "d3", "iswon": F.col("id") != "d3"})
    run = lambda rows, day: graph.build(spark, rows, folder, day, closed_deals="flag", bookings_insert_only=True, buckets=BUCKETS, checks=False)
    run(start, datetime(2026, 1, 2))
    wh = run(raw(spark, "New", deals=(3,)), datetime(2026, 1, 3))
    assert rows_of(wh.read("fct_sales_pipeline").select("opportunity_id", "is_active")) == [("d3", False)]
    booked = wh.read("fct_bookings").filter("account_id = 'a7'")
    assert booked.count() == 5 and {r[0] for r in booked.select("industry").collect()} == {"Old"}
    assert wh.read("fct_win_rate").filter("account_id = 'a7' and industry = 'New'").count() == 5
