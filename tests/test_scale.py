"""Plans: hot keys are split, sizes are checked before broadcasting, columns and filters reach the scan."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from bindings.crm import Crm
from revstream.operators.dedup import dedup_latest
from revstream.operators.quantile import exact_percentiles
from revstream.plans import analytics
from revstream.plans.enrich import line_item_rollup, lookup, lookup_if_set


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled(spark, **more):
    """No broadcasts, and thresholds at which small test data counts as skewed."""
    return settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
            "spark.sql.shuffle.partitions": "8",
            **more,
        },
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_facts(spark, n=60_000):
    """A third of the rows on one key, another part on NULL."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 8).select(F.col("id").alias("fact"), key.alias("account_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_lookup_splits_a_hot_key(spark):
    accounts = spark.range(5000).select(F.col("id").alias("account"), F.concat(F.lit("n"), "id").alias("name"))
    with shuffled(spark):
        df = lookup(hot_facts(spark), accounts, "account_id", "account", account_name="name")
        text = final_plan(df)
        assert "SortMergeJoin(skew=true)" in text
        assert df.count() == 60_000 and df.filter("account_name = 'n7'").count() == hot_facts(spark).filter("account_id = 7").count()


def test_hot_key_is_split_even_when_an_aggregate_on_it_follows(spark):
    accounts = spark.range(5000).select(F.col("id").alias("account"), F.concat(F.lit("n"), "id").alias("name"))
    with shuffled(spark):
        df = lookup(hot_facts(spark), accounts, "account_id", "account", account_name="name")
        assert "SortMergeJoin(skew=true)" in final_plan(df.groupBy("account_id").agg(F.count("account_name"), F.max("text")))


def test_line_items_are_reduced_per_product_before_per_deal(spark):
    items = spark.range(100).selectExpr("id % 3 as opportunity_id", "concat('p', id % 7) as product_name", "cast(1 as decimal(38,2)) as total_price")
    text = plan(line_item_rollup(items))
    assert "hashpartitioning(opportunity_id" in text and "product_name" in text.split("hashpartitioning(")[2]
    assert text.count("partial_") >= 2


def test_touches_are_reduced_before_they_meet_bookings(spark):
    demand = spark.range(10).selectExpr(
        "id as campaign_member_id", "id % 2 as campaign_id", "id % 4 as converted_opportunity_id_attr", "timestamp_ntz'2026-01-01 00:00:00' as member_created_at"
    )
    bookings = spark.range(4).selectExpr("id as opportunity_id", "cast(10 as decimal(38,2)) as booking_amount")
    with shuffled(spark):
        for model in ("first", "last", "linear"):
            text = plan(analytics.attribution(demand, bookings, model))
            join = text.index("SortMergeJoin")
            assert "partial_" in text[join:], model


def test_percentiles_never_gather_a_group(spark):
    df = spark.range(1000).selectExpr("'g' as g", "cast(id as double) as x")
    with shuffled(spark):
        text = plan(exact_percentiles(df, "g", "x", {"p": 0.5}))
    assert "percentile(" not in text.replace("percentile_approx", "")
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert joins and all("_salt" in j or "_range" in j for j in joins)


def test_dedup_keeps_one_row_per_task_of_a_hot_key(spark):
    df = spark.range(0, 10_000, 1, 4).selectExpr("id % 2 as id", "id as ts")
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        latest = dedup_latest(df, "id", [F.desc("ts")])
        assert sorted(r.ts for r in latest.collect()) == [9998, 9999]
        text = plan(latest)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


@pytest.mark.parametrize("name", ["pipeline", "bookings", "win_rate"])
def test_facts_join_no_dimension_twice_and_prune_columns(spark, sf_dir, name):
    c = Crm(spark, sf_dir)
    df = getattr(c, name).select("opportunity_id", "account_sk", "owner_sk", "employee_segment")
    text = plan(df)
    assert text.count("customer.parquet") == 1 and text.count("supplier.parquet") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_staging_reads_only_the_columns_it_needs(spark, sf_dir):
    text = plan(Crm(spark, sf_dir).opportunities.select("opportunity_id", "amount"))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_orderkey" in schema and "o_custkey" not in schema and "o_orderdate" not in schema


def largest_share(df):
    """The part of the rows that the fullest partition holds."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def dealt(spark):
    """Plain shuffled joins: what one task gets is what its keys give it."""
    return shuffled(spark, **{"spark.sql.adaptive.enabled": "false"})


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_lookup_if_set_deals_null_keys_to_all_tasks(spark, kind):
    key = F.when(F.col("id") % 4 == 0, F.col("id") % 700).cast(kind)
    facts = spark.range(0, 8_000, 1, 4).select("id", key.alias("account_id"), F.lit(None).cast("string").alias("text"))
    accounts = spark.range(500).select(F.col("id").cast(kind).alias("account"), F.concat(F.lit("n"), "id").alias("name"))
    accounts = accounts.union(accounts.limit(3)).union(spark.createDataFrame([(None, "none")], f"account {kind}, name string"))
    with dealt(spark):
        plain, spread = (fn(facts, accounts, "account_id", "account", name="name") for fn in (lookup, lookup_if_set))
        assert largest_share(plain) > 0.7 and largest_share(spread) < 0.3
        assert spread.columns == plain.columns and sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_members_without_a_contact_or_a_deal_are_dealt_to_all_tasks(spark, sf_dir):
    with dealt(spark):
        assert largest_share(Crm(spark, sf_dir).demand) < 0.4
