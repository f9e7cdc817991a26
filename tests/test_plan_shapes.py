"""What the physical plans must and must not hold."""

import pytest
from checks import registry
from helpers import plan_of
from pyspark.sql import functions as F

from incident_mart import operators as ops

SF = "/root/testdata/sf0.001"
#: Queries that only build a plan; the others write files first.
LAZY = [
    "fact_latest_join",
    "stg_persons",
    "stg_vehicles",
    "age_filter",
    "location_points",
    "latest_per_group",
    "inner_join_key",
    "surrogate_key",
    "page_first_wins",
    "page_prefix",
    "page_gap",
    "clean_crashes",
    "clean_persons",
    "clean_prefix",
    "contract_check",
    "merge_new_rows",
    "merge_source_dups",
    "json_bodies",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_fact_cuts_groups_before_the_shuffle_and_prunes(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = registry.fact_latest_join(spark, SF)
    plan = plan_of(fact)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 3
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert not any("l_tax" in s or "l_extendedprice" in s or "o_totalprice" in s for s in scans)


def test_filter_reaches_the_scan(spark, tmp_path, conf):
    conf("spark.sql.maxMetadataStringLength", "1000")
    path = str(tmp_path / "p")
    spark.createDataFrame(
        [("DRIVER", 20, "x")], "person_type string, age bigint, note string"
    ).write.parquet(path)
    df = spark.read.parquet(path).filter(F.col("age") != 0)
    grown = (F.col("person_type") != "PASSENGER") & (F.col("age") > 15)
    plan = plan_of(df.filter(grown).select("age"))
    assert "GreaterThan(age,15)" in plan and "Not(EqualTo(person_type,PASSENGER))" in plan
    assert "note" not in plan


def test_first_page_wins_shuffles_rows_on_key_and_page(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(registry.page_first_wins(spark, SF))
    assert "partial_min" in plan and "Window" not in plan
    wide = [s for s in plan.splitlines() if "Exchange hashpartitioning(coalesce(l_orderkey" in s]
    assert wide and all("l_linenumber" in s or "__page" in s for s in wide)


def test_merge_shrinks_both_key_sets(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(registry.merge_source_dups(spark, SF))
    assert "partial_count" in plan and "HashAggregate(keys=[__key" in plan
    assert "LeftAnti, BuildRight" in plan and "LeftSemi" in plan


def test_stored_decisions_spare_the_rows_a_shuffle(spark, tmp_path):
    source = spark.range(1000).selectExpr("id as k", "id div 100 as page_no", "uuid() as x")
    source.write.parquet(str(tmp_path / "s"))
    rows = spark.read.parquet(str(tmp_path / "s"))
    ops.key_status(rows, spark.range(990).toDF("k"), "k").write.parquet(str(tmp_path / "k"))
    fresh = ops.rows_of_new_keys(rows, spark.read.parquet(str(tmp_path / "k")), "k")
    ops.repeated_keys(rows, "k", "page_no").write.parquet(str(tmp_path / "r"))
    first = ops.drop_later_pages(rows, spark.read.parquet(str(tmp_path / "r")), "k", "page_no")
    for df in (fresh, first):
        plan = plan_of(df)
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert (fresh.count(), first.count()) == (10, 1000)


def test_merge_reads_only_the_key_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(9).selectExpr("id as k", "id as a", "id as b").write.parquet(path)
    source = spark.range(3).selectExpr("id as k", "id as a", "id as b")
    plan = plan_of(ops.unmatched_rows(source, spark.read.parquet(path), "k"))
    assert "ReadSchema: struct<k:bigint>" in plan


def test_small_batch_does_not_shuffle_the_table(spark, tmp_path, conf):
    conf("spark.sql.adaptive.enabled", "false")
    path = str(tmp_path / "t")
    spark.range(10000).selectExpr("id as k").write.parquet(path)
    keys = ops.counted_keys(spark.range(9990, 10020).selectExpr("id as k"), "k")
    status = ops.status_of(keys, spark.read.parquet(path), "k", few_keys=True)
    assert status.count() == 20
    table = plan_of(status).split("FileScan")[0]
    assert "BroadcastHashJoin [k" in plan_of(status) or "LeftSemi, BuildRight" in table
    assert ops.status_of(keys, spark.read.parquet(path), "k").count() == 20


def skewed(spark, conf):
    """Sizes at which a third of 60,000 rows counts as skew."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    rows = spark.range(0, 60000, 1, 8).select(key.alias("k"), F.uuid().alias("x"))
    return rows


def test_hot_key_of_a_join_is_split(spark, conf):
    rows = skewed(spark, conf)
    crashes = spark.range(-1, 60000, 1, 8).withColumnRenamed("id", "k").withColumn("y", F.lit(1))
    joined = ops.join_on_key(rows, crashes, "k", ["x"], ["y"]).agg(F.max("x"), F.sum("y"))
    assert joined.collect()[0][1] == 60000
    assert "skew=true" in plan_of(joined)


def test_hot_key_of_a_merge_is_split_below_the_hot_limit_too(spark, conf):
    rows = skewed(spark, conf)
    target = spark.range(0, 100, 1, 4).withColumnRenamed("id", "k")
    fresh = ops.unmatched_rows(rows, target, "k").agg(F.max("x"), F.count("x"))
    assert fresh.collect()[0][1] == 60000 - 66
    assert "skew=true" in plan_of(fresh)


@pytest.mark.parametrize("known", [True, False])
def test_rows_of_a_hot_key_are_not_shuffled(spark, conf, known):
    rows = skewed(spark, conf)
    conf("spark.sql.adaptive.enabled", "false")
    target = spark.range(-1 if known else 0, 100, 1, 4).withColumnRenamed("id", "k")
    fresh = ops.unmatched_rows(rows, target, "k", hot_rows=1000)
    hot = fresh.filter("k = -1").groupBy(F.spark_partition_id().alias("task")).count()
    per_task = [r["count"] for r in hot.collect()]
    assert per_task == ([] if known else [2500] * 8)
    assert fresh.count() == 60000 - 66 - (20000 if known else 0)


def test_hot_key_of_the_dedup_does_not_meet_in_one_task(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pages = spark.range(0, 60000, 1, 8).selectExpr(
        "case when id % 3 = 0 then -1 else id end as k", "id div 1000 as page_no"
    )
    plan = plan_of(ops.first_page_wins(pages, "k", "page_no"))
    assert "hashpartitioning(coalesce(k" in plan and "page_no" in plan
    spread = pages.filter("k = -1").select(F.expr("pmod(hash(k, page_no), 8)").alias("p"))
    assert spread.groupBy("p").count().agg(F.max("count")).first()[0] < 10000


def test_prefix_limit_is_computed_once(spark):
    df = registry.page_prefix(spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in final
