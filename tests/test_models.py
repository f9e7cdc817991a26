from datetime import datetime

from helpers import rows
from pyspark.sql import functions as F

from incident_mart import plans
from incident_mart.operators import schema_contract, with_surrogate_key
from incident_mart.schemas import CRASHES, FEEDS, PERSONS, STAGING_CONTRACTS, VEHICLES
from incident_mart.sources import compact_table, insert_only_merge, remove_replaced

EARLY, LATE = datetime(2024, 1, 5, 10), datetime(2024, 12, 6, 11)


def persons(spark, data):
    """Rows of (person_id, person_type, crash, date, equipment, age)."""
    full = [(p, t, c, "1", d, "F", e, "NOT DEPLOYED", a) for p, t, c, d, e, a in data]
    df = spark.createDataFrame(full, PERSONS.wide_schema)
    return with_surrogate_key(df, PERSONS.hash_columns)


def crashes(spark, data):
    """Rows of (crash, date, latitude)."""
    full = [(c, d, "CLEAR", "DAY", "NONE", 2, 1, y, -87.5) for c, d, y in data]
    return with_surrogate_key(
        spark.createDataFrame(full, CRASHES.wide_schema), CRASHES.hash_columns
    )


def vehicles(spark, data):
    full = [(u, "c1", EARLY, "1", "DRIVER", 7, make, model) for u, make, model in data]
    return with_surrogate_key(
        spark.createDataFrame(full, VEHICLES.wide_schema), VEHICLES.hash_columns
    )


def test_staged_persons(spark):
    df = persons(
        spark,
        [
            ("p0", "DRIVER", "c1", EARLY, "BELT", 0),
            ("p1", "DRIVER", "c1", EARLY, None, None),
            ("p2", "DRIVER", "c1", LATE, None, 1),
            ("p3", "DRIVER", "c1", None, "", 30),
        ],
    )
    staged = plans.stg_persons_data(df)
    assert len(staged.columns) == 15
    got = rows(
        staged,
        "person_id",
        "safety_equipment_updated",
        "crash_month_number",
        "crash_year",
        "traffic_crash_date",
        "crash_month",
    )
    assert got == [
        ("p2", "USAGE UNKNOWN", 12, 2024, LATE, "December"),
        ("p3", "", None, None, None, "Unknown"),
    ]


def test_staged_vehicles_move_filled_columns_last(spark):
    staged = plans.stg_vehicles_data(vehicles(spark, [("1", None, ""), ("2", "FORD", None)]))
    assert staged.columns[-2:] == ["make", "model"]
    assert rows(staged, "make", "model") == [("FORD", "PEDESTRAIN"), ("PEDESTRAIN", "")]


def test_staging_contracts_hold(spark):
    models = plans.build_models(
        crashes(spark, [("c1", EARLY, 41.5)]),
        vehicles(spark, [("1", "a", "b")]),
        persons(spark, [("p", "DRIVER", "c1", EARLY, "BELT", 20)]),
    )
    for name, contract in STAGING_CONTRACTS.items():
        assert schema_contract(models[name], contract).filter(~F.col("ok")).count() == 0


def test_fact_takes_latest_person_per_type_and_crash(spark):
    people = persons(
        spark,
        [
            ("p1", "DRIVER", "c1", EARLY, "A", 20),
            ("p2", "DRIVER", "c1", LATE, "B", 20),
            ("p0", "DRIVER", "c1", LATE, "C", 20),
            ("p4", "PASSENGER", "c1", LATE, "D", 20),
            ("p5", "PEDESTRIAN", "c1", EARLY, None, 20),
            ("p6", "DRIVER", "elsewhere", EARLY, "E", 20),
            ("p7", None, "c1", EARLY, "F", 20),
            ("p8", "BICYCLE", "c1", EARLY, "G", 0),
        ],
    )
    traffic = plans.stg_traffic_data(crashes(spark, [("c1", EARLY, 41.5)]))
    fact = plans.fact_traffic_accidents(plans.stg_persons_data(people), traffic)
    assert rows(fact, "person_type", "traffic_crash_date", "crash_month", "safety_equipment") == [
        ("DRIVER", LATE, "December", "C"),
        ("PEDESTRIAN", EARLY, "January", None),
    ]


def test_fact_fans_out_over_repeated_crashes(spark):
    people = persons(spark, [("p1", "DRIVER", "c1", EARLY, "A", 20)])
    twice = crashes(spark, [("c1", EARLY, 41.5), ("c1", EARLY, 41.75)])
    assert plans.fact_traffic_accidents(plans.stg_persons_data(people), twice).count() == 2


def test_age_distri(spark):
    people = persons(
        spark,
        [
            ("p1", "DRIVER", "c1", EARLY, "A", 15),
            ("p2", "DRIVER", "c1", EARLY, "B", 16),
            ("p3", "PASSENGER", "c1", EARLY, "C", 40),
            ("p4", None, "c1", EARLY, "D", 40),
        ],
    )
    grown = plans.age_distri(plans.stg_persons_data(people))
    assert rows(grown) == [(EARLY, 16, "F", "B", "NOT DEPLOYED")]


def test_crashes_location(spark):
    located = plans.crashes_location(crashes(spark, [("c1", EARLY, 41.5), ("c2", EARLY, None)]))
    assert located.columns[:5] == [
        "longitude",
        "latitude",
        "geo_point",
        "injuries_total",
        "injuries_fatal",
    ]
    got = {r.latitude: (r.geo_point and tuple(r.geo_point), r.geo_wkt) for r in located.collect()}
    assert got == {41.5: ((-87.5, 41.5), "POINT(-87.5 41.5)"), None: (None, None)}


def test_sample_applies_to_persons_and_traffic(spark):
    many = crashes(spark, [(f"c{i}", EARLY, 41.5) for i in range(30)])
    people = persons(spark, [(f"p{i}", "DRIVER", f"c{i}", EARLY, "A", 20) for i in range(30)])
    units = vehicles(spark, [(str(i), "a", "b") for i in range(30)])
    models = plans.build_models(many, units, people, sample=10)
    counts = {name: models[name].count() for name in ("stg_persons_data", "stg_traffic_data")}
    assert counts == {"stg_persons_data": 10, "stg_traffic_data": 10}
    assert models["stg_vehicles_data"].count() == 30


def test_catalog_views_outlast_the_session(spark, tmp_path):
    """Another session reads the mart by name, and sees what each publication found live."""
    layout = plans.Layout(str(tmp_path / "mart"))
    feeds = {name: keyed(spark, feed, [1, 2]) for name, feed in FEEDS.items()}
    for name, feed in FEEDS.items():
        insert_only_merge(feeds[name], layout.table(feed), feed.table_schema, "one")
    plans.publish_models(spark, layout)
    made = plans.publish_catalog(spark, layout, "lasting_mart")
    assert len(made) == 9
    later = spark.newSession()
    models = plans.build_models(**plans.read_tables(spark, layout))
    for name in plans.catalog.STAGING_SQL:
        seen = later.table(f"lasting_mart.{name}")
        assert seen.columns == models[name].columns
        assert sorted(map(repr, seen.collect())) == sorted(map(repr, models[name].collect()))
    assert later.table("lasting_mart.age_distri").count() == models["age_distri"].count()

    insert_only_merge(keyed(spark, CRASHES, [2, 3]), layout.table(CRASHES), CRASHES.table_schema, "two")
    assert later.table("lasting_mart.stg_traffic_data").count() == 2
    plans.publish_catalog(spark, layout, "lasting_mart")
    assert later.table("lasting_mart.stg_traffic_data").count() == 3
    compact_table(spark, layout.table(CRASHES), CRASHES.table_schema)
    # Old folders are still there for the view as it was made.
    assert later.table("lasting_mart.stg_traffic_data").count() == 3
    plans.publish_catalog(spark, layout, "lasting_mart")
    remove_replaced(spark, layout.table(CRASHES))
    assert spark.newSession().sql("select count(*) from lasting_mart.stg_traffic_data").first()[0] == 3


def keyed(spark, feed, ids):
    """A row of the feed's loaded form for each number."""
    values = {"string": "cast(id as string)", "timestamp": "timestamp '2024-03-05 01:02:03'"}
    columns = [f"{values.get(c.loaded, f'cast(id as {c.loaded})')} as {c.name}" for c in feed.columns]
    frame = spark.createDataFrame([(i,) for i in ids], "id int").selectExpr(*columns)
    return with_surrogate_key(frame, feed.hash_columns)


def test_a_kept_fact_equals_the_whole_one_and_touches_its_parts_only(spark, tmp_path):
    def staged(data):
        return plans.stg_persons_data(persons(spark, data))

    hot = [(f"p{i}", "DRIVER", "c0", EARLY, "BELT", 30) for i in range(200)]
    loads = [
        (hot + [("a", "DRIVER", "c1", EARLY, "BELT", 20), ("b", "PASSENGER", "c1", LATE, "X", 20)], ["c0", "c1", "c1"]),
        ([("c", "DRIVER", "c1", LATE, "NONE", 40), ("d", "CYCLIST", "c2", None, None, 9), ("e", None, "c1", LATE, "X", 9)], []),
        ([], ["c2", "c3"]),
        ([("a0", "DRIVER", "c1", LATE, "TIE", 40), ("f", "DRIVER", None, LATE, "X", 40), ("g", "DRIVER", "c9", LATE, "X", 0)], [None]),
    ]
    kept = plans.KeptFact(str(tmp_path / "kept"), parts=64)
    all_people, all_crashes = [], []
    for i, (people, ids) in enumerate(loads):
        found = crashes(spark, [(c, EARLY, 41.5) for c in ids])
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "kept" / "fact").rglob("*.parquet")}
        touched = kept.bring_in(spark, f"load-{i}", staged(people), found)
        again = kept.bring_in(spark, f"load-{i}", staged(people), found)
        assert again == touched and len(touched) <= len(people) + len(ids)
        for file, written in before.items():
            if int(file.parent.name.split("=")[1]) not in touched:
                assert file.stat().st_mtime_ns == written
        all_people, all_crashes = all_people + people, all_crashes + ids
        whole = plans.fact_traffic_accidents(
            staged(all_people), crashes(spark, [(c, EARLY, 41.5) for c in all_crashes])
        )
        assert rows(kept.read(spark)) == rows(whole)
    assert kept.bring_in(spark, "none", staged([]), crashes(spark, [])) == []


def test_a_kept_fact_ranks_each_load_once(spark, tmp_path, monkeypatch):
    from incident_mart.plans import kept_fact, models

    ranked = []
    for where in (kept_fact, models):
        rank = where.latest_per_group
        monkeypatch.setattr(where, "latest_per_group", lambda *a, rank=rank: ranked.append(1) or rank(*a))
    kept = plans.KeptFact(str(tmp_path / "kept"), parts=4)
    people = [(f"p{i}", "DRIVER", f"c{i % 9}", LATE if i % 2 else EARLY, "BELT", 30) for i in range(40)]
    found = crashes(spark, [(f"c{i}", EARLY, 41.5) for i in range(9)])
    for load, some in (("one", people[:25]), ("two", people[25:])):
        kept.bring_in(spark, load, plans.stg_persons_data(persons(spark, some)), found.limit(9 if load == "one" else 0))
    assert len(ranked) == 2
    monkeypatch.undo()
    whole = plans.fact_traffic_accidents(plans.stg_persons_data(persons(spark, people)), found)
    assert rows(kept.read(spark)) == rows(whole)


def test_a_kept_fact_reads_touched_parts_only(spark, tmp_path):
    kept = plans.KeptFact(str(tmp_path / "kept"), parts=64)
    people = [(f"p{i}", "DRIVER", f"c{i}", EARLY, "BELT", 30) for i in range(100)]
    some = crashes(spark, [(f"c{i}", EARLY, 41.5) for i in range(100)])
    kept.bring_in(spark, "one", plans.stg_persons_data(persons(spark, people)), some)
    latest = spark.read.parquet(str(tmp_path / "kept" / "latest"))
    part = kept._read(spark, "latest", latest.schema, [3])
    assert {f.rsplit("/", 2)[1] for f in part.inputFiles()} <= {f"crash_part={k}" for k in range(64)}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "crash_part" in plan.split("PartitionFilters")[1]
