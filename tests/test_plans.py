"""What the physical plans must look like."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from statpanel import operators as op
from statpanel import sources as src
from statpanel.operators.rank import BITS, _bits
from statpanel.plans import registry, views
from statpanel.schema import enriched

SF_DIR = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    """The adaptive plan after the query has run."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def panel(spark, folder):
    topics = F.array(*[F.lit(t) for t in views.EXPENDITURE_TOPICS])
    rows = spark.range(4000).select(
        F.lit("T-1").alias("code"),
        F.lit("0").alias("geofips"),
        F.concat(F.lit("n"), (F.col("id") % 50).cast("string")).alias("geoname"),
        (F.col("id") / 50 % 20 + 1995).cast("int").cast("string").alias("timeperiod"),
        F.lit("u").alias("cl_unit"),
        F.lit(0).cast("bigint").alias("unit_mult"),
        (F.col("id") * 37 % 1009).alias("datavalue"),
        F.lit(None).cast("string").alias("noteref"),
        F.lit("T").alias("table"),
        F.lit("1").alias("endpoint"),
        topics[(F.col("id") / 1000).cast("int")].alias("topic"),
    )
    rows.write.parquet(f"{folder}/panel")
    return spark.read.schema(enriched()).parquet(f"{folder}/panel")


def test_filters_and_columns_reach_the_scan(panel, capsys):
    views.consumer_expenditures(panel).explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PushedFilters: \[.*In\(topic", plan)
    assert "GreaterThanOrEqual(timeperiod,2000)" in plan
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan):
        assert sorted(c.split(":")[0] for c in schema.split(",")) == ["datavalue", "geoname", "timeperiod", "topic"]


def test_change_and_rank_share_one_scan_and_one_shuffle(panel):
    plan = final(views.consumer_expenditures(panel))
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") >= 2


def test_no_global_sort_below_a_window(panel):
    for df in (views.consumer_expenditures(panel), views.industry_compensation(panel)):
        assert "rangepartitioning" not in planned(df)


def test_no_window_over_a_whole_rank_group(panel):
    """The rank windows see distinct values of one slot range, never the rows of a group."""
    plan = planned(op.rank_within(panel, ["timeperiod", "topic"], "datavalue", "r"))
    windows = re.findall(r"Window \[(.*?)\], \[(.*?)\]", plan)
    assert not [keys for what, keys in windows if "dense_rank" in what and "_fine" not in keys]


def test_top_uses_a_group_limit_before_the_shuffle(panel):
    plan = planned(op.top_per_group(panel, ["geoname"], "datavalue", k=3))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_short_name_lists_are_broadcast_and_long_ones_not(spark, panel, folder):
    names = panel.select("geoname").limit(10)
    names.write.parquet(f"{folder}/names")
    listed = spark.read.parquet(f"{folder}/names")
    assert "LeftSemi, BuildRight" in planned(op.keep_listed(panel, listed, "geoname"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = planned(op.keep_listed(panel, listed, "geoname"))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_routing_and_checks_do_not_shuffle_rows(panel):
    assert "Exchange" not in planned(op.route(panel))
    plan = planned(op.check_keys(panel.withColumn("dataset", F.lit("d"))))
    assert plan.count("Exchange hashpartitioning") == 1


def test_symmetric_difference_shuffles_once(panel):
    names = panel.select("geoname")
    assert planned(op.symmetric_difference(names, names)).count("Exchange hashpartitioning") == 1


@pytest.fixture
def skew_session(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def hot(spark, folder):
    """A third of the rows in one group, most of them with one value."""
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 4000).cast("string")).alias("g"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("t"),
    )
    rows.write.parquet(f"{folder}/hot")
    return spark.read.parquet(f"{folder}/hot")


def test_hot_groups_are_split_in_the_joins(skew_session, folder):
    rows = hot(skew_session, folder)
    ranked = op.rank_within(rows, ["g"], "v", "r")
    assert "skew=true" in final(ranked)
    assert "skew=true" in final(op.with_top(rows, ["g"], "v", "t", "top"))
    assert "skew=true" in final(op.keep_listed(rows, rows.select("g"), "g"))
    tied = rows.withColumn("v", F.lit(1))
    assert "skew=true" in final(op.top_per_group(tied, ["g"], "v"))
    window = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    want = rows.withColumn("r", F.dense_rank().over(window).cast("bigint"))
    assert ranked.exceptAll(want).count() == 0 and ranked.count() == 60000


def test_a_hot_key_is_split_where_frames_are_merged(skew_session, folder):
    rows = hot(skew_session, folder).withColumnRenamed("g", "k")
    first = rows.filter("v % 2 = 0 and k <> 'hot'")
    merged = op.first_wins([first, rows], ["k"])
    plan = final(merged)
    assert "skew=true" in plan and "Window" not in plan and "collect_" not in plan
    keys = {r.k for r in first.select("k").distinct().collect()}
    assert merged.count() == first.count() + rows.filter(~F.col("k").isin(*keys)).count()


def test_a_hot_key_is_split_where_topics_are_aligned(skew_session, folder):
    rows = hot(skew_session, folder).select("g", F.col("t").alias("datavalue"), F.lit("J").alias("topic"))
    other = rows.select("g").distinct().select("g", F.md5("g").alias("datavalue"), F.lit("P").alias("topic"))
    rows.unionByName(other).write.parquet(f"{folder}/panel")
    aligned = op.align_topics(skew_session.read.parquet(f"{folder}/panel"), ["g"], {"J": "j", "P": "p"})
    plan = final(aligned)
    assert "skew=true" in plan and "collect_" not in plan
    assert aligned.exceptAll(rows.select("g", F.col("datavalue").alias("j"), F.md5("g").alias("p"))).isEmpty()
    assert aligned.count() == 60000


def test_a_bucketed_table_needs_no_shuffle_below_its_windows(spark, panel, folder):
    by = ["geoname", "topic"]
    table = src.create_table(panel, "statpanel_in_buckets", f"{folder}/b", bucket_by=by, sort_by=["timeperiod"], buckets=5)
    changed = op.change(table, by, "timeperiod", "datavalue")
    plan = final(changed)
    assert "Window" in plan and "Exchange" not in plan
    assert len(table.inputFiles()) <= 5
    assert changed.exceptAll(op.change(panel, by, "timeperiod", "datavalue")).isEmpty() and changed.count() == 4000
    totals = table.groupBy(*by).agg(F.sum("datavalue"))
    assert "Exchange" not in final(totals)


def test_no_window_of_a_whole_series_with_ranges(skew_session, folder):
    rows = hot(skew_session, folder).withColumn("p", F.col("t"))
    changed = op.change(rows, ["g"], "p", "v", ranges=12)
    counts = skew_session.read.parquet(os.path.dirname(changed.inputFiles()[0])).groupBy("g", "_range").count()
    assert counts.agg(F.max("count")).first()[0] < 8000  # of 20,000 rows of the hot series
    assert re.search(r"Window \[.*\], \[g#\d+, _chunk#\d+\]", planned(changed))
    window = Window.partitionBy("g").orderBy(F.asc_nulls_last("p"), F.asc_nulls_last("v"))
    assert changed.select("g", "p", "v", "prev").exceptAll(rows.select("g", "p", "v", F.lag("v").over(window))).isEmpty()


def test_ties_for_the_top_need_no_window(panel):
    """A group of equal values must not meet in one task."""
    assert "Window" not in planned(views.industry_compensation(panel.withColumn("datavalue", F.lit(1))))


def test_rank_of_fractions_needs_many_windows(spark):
    rows = spark.range(200_000).select(F.lit("g").alias("g"), (F.hash("id") / 2.0**33 + 0.25).alias("v"))
    ranked = op.rank_within(rows, ["g"], "v", "r")
    values = rows.distinct().withColumn("s", F.shiftright(_bits(F.col("v")), BITS))
    assert values.groupBy("s").count().agg(F.max("count"), F.count("*")).first()[0] < 1000
    want = rows.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).cast("bigint"))
    assert ranked.exceptAll(want).isEmpty() and ranked.count() == 200_000


def test_membership_is_an_equi_join(spark):
    plan = planned(registry.semi_join_values(spark, SF_DIR))
    assert re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) .*LeftSemi", plan)
    assert "NestedLoop" not in plan
    kept = registry.semi_join_values(spark, SF_DIR)
    assert 0 < kept.count() < registry.csv_dictionary(spark, SF_DIR).count()


@pytest.mark.parametrize(
    "name, facts", [("view_employment_population", 1), ("view_employment_population_customers", 1), ("first_wins_merge", 2)]
)
def test_each_fact_table_is_scanned_once(spark, name, facts):
    """first_wins merges two frames, each of which reads the orders."""
    plan = final(registry.QUERIES[name](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[[^]]*o_custkey", plan)) <= facts
