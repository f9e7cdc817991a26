"""The bucketed tables: the same fact without a shuffle, and hot ids beside the buckets."""

import uuid

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F
from test_models import EARLY, LATE, crashes, persons

from incident_mart import plans
from incident_mart.schemas import CRASHES, PERSONS
from incident_mart.sources import compact_table, files, insert_only_merge, store_counted


def people(spark, data):
    return plans.stg_persons_data(persons(spark, data))


def found(spark, ids):
    return crashes(spark, [(c, EARLY, 41.5) for c in ids])


def kept(tmp_path, **options):
    return plans.CrashBuckets(f"b_{abs(hash(str(tmp_path)))}", str(tmp_path / "b"), buckets=4, **options)


USUAL = [(f"p{i}", "DRIVER", f"c{i % 40}", LATE if i % 3 else EARLY, "BELT", 30) for i in range(200)]


def test_neither_rank_nor_join_shuffles(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = kept(tmp_path)
    ids = [f"c{i}" for i in range(50)]
    store.add(spark, "one", people(spark, USUAL[:120]), found(spark, ids[:30]))
    store.add(spark, "two", people(spark, USUAL[120:]), found(spark, ids[30:]))
    fact = store.fact(spark)
    plan = plan_of(fact)
    assert "SortMergeJoin" in plan and "WindowGroupLimit" in plan
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert rows(fact) == rows(plans.fact_traffic_accidents(people(spark, USUAL), found(spark, ids)))


def test_large_buckets_are_ranked_in_slices(spark, tmp_path, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = kept(tmp_path)
    ids = [f"c{i}" for i in range(50)]
    store.add(spark, "one", people(spark, USUAL[:120]), found(spark, ids[:30]))
    store.add(spark, "two", people(spark, USUAL[120:]), found(spark, ids[30:]))
    monkeypatch.setattr(plans.bucketed, "SLICE_ROWS", 10)
    fact = store.fact(spark)
    plan = plan_of(fact)
    # 200 rows in 4 buckets: five slices, each with a task of its own for every bucket.
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
    assert fact.rdd.getNumPartitions() == 20
    assert rows(fact) == rows(plans.fact_traffic_accidents(people(spark, USUAL), found(spark, ids)))


def test_hot_ids_and_missing_ones_lie_beside_the_buckets(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = kept(tmp_path, hot_rows=50)
    hot = [(f"h{i}", f"T{i % 3}", "hot", EARLY, "BELT", 30) for i in range(60)]
    none = [(f"n{i}", "DRIVER", None, EARLY, "BELT", 30) for i in range(9)]
    # Some of the hot id's rows come before it is hot, some after.
    loads = [hot[:20] + USUAL, hot[20:55] + none, hot[55:]]
    ids = [["hot", "c1"], [None, "c2", "c3"], ["hot", "c1"]]
    for i, (some, which) in enumerate(zip(loads, ids, strict=True)):
        store.add(spark, f"l{i}", people(spark, some), found(spark, which))
        so_far = people(spark, sum(loads[: i + 1], []))
        crashed = found(spark, sum(ids[: i + 1], []))
        assert rows(store.rows(spark, "persons")) == rows(so_far.select(*store.rows(spark, "persons").columns))
        assert rows(store.fact(spark)) == rows(plans.fact_traffic_accidents(so_far, crashed))
    beside = spark.table(f"{store.database}.persons_apart")
    assert {(r.load_id, r.crash_record_id): r["count"] for r in beside.groupBy("load_id", "crash_record_id").count().collect()} == {
        ("l1", "hot"): 35,
        ("l1", None): 9,
        ("l2", "hot"): 5,
    }
    # Only the hot id's rows are shuffled by crash: the join of the others is in the buckets.
    bucketed = plan_of(store.fact(spark)).split("Union")[1].split("SortMergeJoin")[1]
    assert "hashpartitioning(crash_record_id" not in bucketed.split(":- ", 2)[1]


def test_many_apart_ids_are_not_broadcast(spark, tmp_path, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(plans.bucketed, "FEW_IDS", 3, raising=False)
    monkeypatch.setattr(plans.bucketed, "HOT_ROWS", 50)
    store = kept(tmp_path, hot_rows=5)
    hot = [(f"h{i}", f"T{i % 3}", "hot", EARLY, "BELT", 30) for i in range(60)]
    none = [(f"n{i}", "DRIVER", None, EARLY, "BELT", 30) for i in range(9)]
    few = [(f"f{i}", "DRIVER", f"f{i % 30}", EARLY, "BELT", 30) for i in range(60)]
    # One id is apart in the first load, 41 and the hot one later, with rows in the buckets by then.
    loads = [USUAL[:160] + few + USUAL[:6] * 3, hot + none + USUAL[160:], []]
    ids = [["c0", *[f"f{i}" for i in range(9)]], [None, "hot", "c1", "c1"], ["hot", "c2"]]
    for i, (some, which) in enumerate(zip(loads, ids, strict=True)):
        store.add(spark, f"l{i}", people(spark, some), found(spark, which))
        so_far, crashed = people(spark, sum(loads[: i + 1], [])), found(spark, sum(ids[: i + 1], []))
        assert rows(store.rows(spark, "persons")) == rows(so_far.select(*store.rows(spark, "persons").columns))
        assert rows(store.rows(spark, "crashes")) == rows(crashed.select(*store.rows(spark, "crashes").columns))
        fact = store.fact(spark)
        assert rows(fact) == rows(plans.fact_traffic_accidents(so_far, crashed))
        for kind in ("persons", "crashes"):
            for load in range(i + 1):
                parts = files.names_at(spark, f"{store.root}/{kind}_by_crash/load_id=l{load}/*.parquet")
                assert len(parts) <= store.buckets
            assert not spark.catalog.tableExists(f"{store.database}.{kind}_dealt")
            assert not files.exists(spark, f"{store.root}/{kind}_dealt")
    assert spark.table(f"{store.database}.persons_apart").filter("crash_record_id = 'hot'").count() == 60
    # Only ids above HOT_ROWS are broadcast. The others are joined, and in the buckets nothing but
    # their list is shuffled.
    lines = plan_of(store.fact(spark)).splitlines()
    sent = [i for i, line in enumerate(lines) if "BroadcastExchange" in line]
    assert sent and all("> 50" in " ".join(lines[i + 1 : i + 4]) for i in sent)
    usual = lines[: next(i for i, line in enumerate(lines) if line.startswith("   +- "))]
    assert sum("SortMergeJoin" in line and "LeftAnti" in line for line in usual) == 2
    shuffled = [line for line in usual if " Exchange " in line]
    assert shuffled and all("hashpartitioning(apart_id" in line and ", 4)" in line for line in shuffled)


def test_a_load_run_again_replaces_itself_and_a_cut_one_is_not_read(spark, tmp_path, monkeypatch):
    store = kept(tmp_path)
    store.add(spark, "one", people(spark, USUAL), found(spark, ["c1", "c2"]))
    store.add(spark, "one", people(spark, USUAL[:50]), found(spark, ["c1"]))
    one = rows(plans.fact_traffic_accidents(people(spark, USUAL[:50]), found(spark, ["c1"])))
    assert rows(store.fact(spark)) == one

    write = plans.CrashBuckets._write

    def cut(self, spark, load_id, kind, *rest):
        if kind == "crashes":
            raise RuntimeError("killed")
        write(self, spark, load_id, kind, *rest)

    monkeypatch.setattr(plans.CrashBuckets, "_write", cut)
    with pytest.raises(RuntimeError):
        store.add(spark, "two", people(spark, USUAL[50:]), found(spark, ["c3"]))
    assert store.loads(spark) == ["one"] and rows(store.fact(spark)) == one
    assert store.rows(spark, "persons").count() == 50
    monkeypatch.undo()
    store.add(spark, "two", people(spark, USUAL[50:]), found(spark, ["c3"]))
    whole = plans.fact_traffic_accidents(people(spark, USUAL), found(spark, ["c1", "c3"]))
    assert rows(store.fact(spark)) == rows(whole)
    # A load that has become empty leaves nothing behind.
    store.add(spark, "two", people(spark, []), found(spark, []))
    assert rows(store.fact(spark)) == one


def test_files_are_attached_to_a_new_catalog(spark, tmp_path):
    store = kept(tmp_path)
    store.add(spark, "one", people(spark, USUAL), found(spark, ["c1", "c2"]))
    before = rows(store.fact(spark))
    spark.sql(f"DROP DATABASE {store.database} CASCADE")
    assert rows(store.fact(spark)) == before
    other = plans.CrashBuckets(store.database, store.root, buckets=8)
    with pytest.raises(ValueError, match="4 buckets"):
        other.add(spark, "two", people(spark, USUAL), found(spark, []))


def test_empty_loads(spark, tmp_path):
    store = kept(tmp_path)
    store.add(spark, "none", people(spark, []), found(spark, []))
    assert store.fact(spark).count() == 0 and store.rows(spark, "crashes").count() == 0


def test_buckets_catch_up_with_the_loads_of_the_tables(spark, tmp_path):
    layout, store = plans.Layout(str(tmp_path / "mart")), kept(tmp_path)

    def load(name, some, ids):
        insert_only_merge(persons(spark, some), layout.table(PERSONS), PERSONS.table_schema, name)
        insert_only_merge(found(spark, ids), layout.table(CRASHES), CRASHES.table_schema, name)

    load("one", USUAL[:60], ["c1", "c2"])
    assert store.catch_up(spark, layout) == [f"{k}-{n}" for k in ("persons", "crashes") for n in ("created", "one")]
    load("two", USUAL[50:80], ["c2", "c3"])
    assert store.catch_up(spark, layout) == ["persons-two", "crashes-two"]
    compact_table(spark, layout.table(PERSONS), PERSONS.table_schema)
    assert store.catch_up(spark, layout) == ["persons-compact-000001"]
    assert store.catch_up(spark, layout) == []
    models = plans.build_models(**plans.read_tables(spark, layout))
    assert rows(store.fact(spark)) == rows(models["fact_traffic_accidents"])
    load("three", USUAL[80:90], [])
    compact_table(spark, layout.table(PERSONS), PERSONS.table_schema)
    with pytest.raises(ValueError, match="only some"):
        store.catch_up(spark, layout)
    # Buckets that start now take a compaction as one load.
    fresh = plans.CrashBuckets(f"{store.database}_x", f"{store.root}x", buckets=4)
    fresh.catch_up(spark, layout)
    models = plans.build_models(**plans.read_tables(spark, layout))
    assert rows(fresh.fact(spark)) == rows(models["fact_traffic_accidents"])
    with pytest.raises(ValueError, match="all rows"):
        plans.publish_models(spark, layout, sample=5, buckets=fresh)


def test_counts_taken_while_writing_need_no_job(spark, tmp_path):
    def jobs(work):
        group = f"jobs-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            work()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    df = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.count("*").alias("n"))
    got = {}

    def counted():
        got["rows"], got["seen"] = store_counted(
            df, str(tmp_path / "a"), groups=F.count(F.lit(1)), n=F.sum("n"), big=F.count_if(F.col("n") > 142)
        )

    assert jobs(counted) == jobs(lambda: files.store(df, str(tmp_path / "b")))
    assert got["seen"] == {"groups": 7, "n": 1000, "big": 6} and got["rows"].count() == 7
    none, seen = store_counted(df.filter("false"), str(tmp_path / "c"), groups=F.count(F.lit(1)), n=F.sum("n"))
    assert seen == {"groups": 0, "n": None} and none.count() == 0
