import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from helpers import plan_of, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_mart import plans
from incident_mart.plans import feeds
from incident_mart.plans.feeds import KEPT, STATE, empty_pages, kept_pages
from incident_mart.schemas import CRASHES, FEEDS, PAGE, PERSONS, ROW_KEY, VEHICLES
from incident_mart.sources import read_json_pages, read_sent_fields, read_table, sent_fields

CRASH = {
    "crash_record_id": "c1",
    "crash_date": "2023-09-05T19:05:00.000",
    "weather_condition": "CLEAR",
    "lighting_condition": "DAYLIGHT",
    "road_defect": "NO DEFECTS",
    "injuries_total": "2",
    "injuries_fatal": "0",
    "latitude": "41.854120263",
    "longitude": "-87.6",
}
VEHICLE = {
    "crash_unit_id": "100",
    "crash_record_id": "c1",
    "crash_date": "2023-09-05T19:05:00.000",
    "unit_no": "1",
    "unit_type": "DRIVER",
    "vehicle_id": "200",
    "make": "FORD",
    "model": "F150",
}
PERSON = {
    "person_id": "O1",
    "person_type": "DRIVER",
    "crash_record_id": "c1",
    "vehicle_id": "0200",
    "crash_date": "2023-09-05T19:05:00.000",
    "sex": "F",
    "safety_equipment": "BELT",
    "airbag_deployed": "NO",
    "age": "34",
}
RECORDS = {"crashes": CRASH, "vehicles": VEHICLE, "persons": PERSON}
AT = datetime(2023, 9, 5, 19, 5)


def raw(spark, feed, pages):
    """A page frame of text: pages of changes to the feed's sample record."""
    data = [
        (n, *[{**RECORDS[feed.name], **change}[c] for c in feed.column_names])
        for n, page in pages.items()
        for change in page
    ]
    return spark.createDataFrame(data, empty_pages(spark, feed).schema)


def ids(df, feed):
    return rows(df, PAGE, feed.page_key)


def test_crashes_drop_incomplete_rows_before_reading_values(spark):
    page = [
        {"crash_record_id": "a", "road_defect": None},
        {"crash_record_id": "b", "crash_date": "bad"},
        {"crash_record_id": "c", "injuries_total": "n/a"},
        {"crash_record_id": "d", "injuries_total": None},
        {"crash_record_id": "e", "latitude": None, "longitude": "x"},
    ]
    got = plans.clean_pages(raw(spark, CRASHES, {0: page}), CRASHES)
    assert rows(got, "crash_record_id", "crash_date", "injuries_total") == [
        ("b", None, 2),
        ("c", AT, 0),
    ]


def test_persons_fill_age_before_dropping(spark):
    page = [
        {"person_id": "a", "age": None},
        {"person_id": "b", "age": "x"},
        {"person_id": "c", "age": "2.9"},
        {"person_id": "d", "sex": None},
    ]
    got = plans.clean_pages(raw(spark, PERSONS, {0: page}), PERSONS)
    assert rows(got, "person_id", "age") == [("a", 0), ("b", 0), ("c", 2)]


def test_vehicle_ids_are_compared_as_numbers(spark):
    pages = {0: [{"crash_unit_id": "7"}, {"crash_unit_id": "07"}], 1: [{"crash_unit_id": "007"}]}
    assert ids(plans.clean_pages(raw(spark, VEHICLES, pages), VEHICLES), VEHICLES) == [
        (0, 7),
        (0, 7),
    ]


def test_first_page_is_the_first_with_a_surviving_row(spark):
    pages = {0: [{"make": None}], 1: [{}], 2: [{}]}
    assert ids(plans.clean_pages(raw(spark, VEHICLES, pages), VEHICLES), VEHICLES) == [(1, 100)]


@pytest.mark.parametrize("text", ["x", "12.5", "12.0"])
def test_unreadable_id_fails_the_load(spark, text):
    pages = raw(spark, VEHICLES, {0: [{}], 1: [{"crash_unit_id": "9", "vehicle_id": text}]})
    with pytest.raises(PySparkException, match="not a whole number"):
        plans.clean_pages(pages, VEHICLES).collect()


def test_prefix_keeps_pages_before_the_bad_one(spark):
    pages = {
        0: [{"crash_unit_id": "1"}],
        1: [{"crash_unit_id": "2"}, {"crash_unit_id": "3", "vehicle_id": "x", "make": None}],
        2: [{"crash_unit_id": "4"}, {"crash_unit_id": "5", "vehicle_id": "x"}],
        3: [{"crash_unit_id": "6"}],
    }
    got = plans.clean_pages(raw(spark, VEHICLES, pages), VEHICLES, on_error="prefix")
    assert ids(got, VEHICLES) == [(0, 1), (1, 2)]


def test_prefix_ends_where_a_whole_page_lacks_a_read_column(spark):
    pages = {0: [{"age": None}, {"person_id": "b"}], 1: [{"person_id": "c", "age": None}]}
    got = plans.clean_pages(raw(spark, PERSONS, pages), PERSONS, on_error="prefix")
    assert ids(got, PERSONS) == [(0, "O1"), (0, "b")]


def test_page_of_dropped_rows_does_not_end_the_load(spark):
    dropped = {"crash_record_id": "b", "road_defect": None}
    pages = {0: [{}], 1: [dropped], 2: [{"crash_record_id": "c"}]}
    got = plans.clean_pages(raw(spark, CRASHES, pages), CRASHES, "prefix", first_page=0)
    assert ids(got, CRASHES) == [(0, "c1"), (2, "c")]


def test_missing_page_ends_the_load(spark):
    pages = {0: [{}], 2: [{"crash_record_id": "c"}]}
    got = plans.clean_pages(raw(spark, CRASHES, pages), CRASHES, "prefix", first_page=0)
    assert ids(got, CRASHES) == [(0, "c1")]


def test_unknown_error_mode(spark):
    pages = empty_pages(spark, CRASHES)
    with pytest.raises(ValueError, match="on_error"):
        plans.clean_pages(pages, CRASHES, on_error="skip")
    with pytest.raises(ValueError, match="on_error"):
        plans.load_pages(pages, CRASHES, plans.Layout("nowhere"), "one", on_error="skip")


def test_broken_body(spark, tmp_path):
    for n, text in enumerate([json.dumps(CRASH), "<html>", json.dumps(CRASH)]):
        folder = tmp_path / f"page_no={n}"
        folder.mkdir()
        (folder / "a.json").write_text(text + "\n")
    pages = read_json_pages(spark, str(tmp_path), CRASHES.column_names)
    assert ids(plans.clean_pages(pages, CRASHES, "prefix"), CRASHES) == [(0, "c1")]
    with pytest.raises(PySparkException, match="no list of records"):
        plans.clean_pages(pages, CRASHES).collect()


def test_absent_column_reads_as_null(spark):
    pages = raw(spark, CRASHES, {0: [{}]}).drop("weather_condition")
    assert plans.clean_pages(pages, CRASHES).count() == 0


def test_absent_key_column_is_refused(spark):
    with pytest.raises(ValueError, match="person_id"):
        plans.clean_pages(raw(spark, PERSONS, {0: [{}]}).drop("person_id"), PERSONS)


def test_conform_types_and_blanks(spark):
    pages = raw(
        spark,
        VEHICLES,
        {0: [{"make": "", "vehicle_id": "3000000000"}, {"crash_unit_id": "007", "model": ""}]},
    )
    done = plans.conform(plans.clean_pages(pages, VEHICLES), VEHICLES)
    assert done.schema == VEHICLES.conformed_schema
    assert rows(done, "crash_unit_id", "vehicle_id", "make", "model") == [
        ("100", None, None, "F150"),
        ("7", 200, "FORD", None),
    ]


def test_conformed_position_is_single_precision(spark):
    odd = [{"crash_record_id": c, "latitude": t} for c, t in (("n", "NaN"), ("i", "-inf"))]
    pages = raw(spark, CRASHES, {0: [{}, *odd]})
    done = plans.conform(plans.clean_pages(pages, CRASHES), CRASHES)
    assert rows(plans.widen(done, CRASHES), "crash_record_id", "latitude") == [
        ("c1", 41.854122161865234),
        ("i", None),
        ("n", None),
    ]


@pytest.mark.parametrize("name", list(FEEDS))
def test_load_twice_adds_nothing(spark, tmp_path, name):
    feed, layout = FEEDS[name], plans.Layout(str(tmp_path))
    key = feed.page_key
    pages = raw(spark, feed, {0: [{}, {key: "11"}], 1: [{}, {key: "12"}]})
    assert plans.load_pages(pages, feed, layout, "one") == 3
    assert plans.load_pages(pages, feed, layout, "two") == 3
    loaded = read_table(spark, layout.table(feed), feed.table_schema)
    assert loaded.columns == [ROW_KEY, *feed.column_names]
    assert loaded.count() == 3
    assert loaded.select(ROW_KEY).distinct().count() == 3


def test_changed_hash_column_is_a_new_row(spark, tmp_path):
    layout = plans.Layout(str(tmp_path))
    for load, latitude in (("one", "41.5"), ("two", "41.75"), ("three", "41.5")):
        plans.load_pages(raw(spark, CRASHES, {0: [{"latitude": latitude}]}), CRASHES, layout, load)
    loaded = read_table(spark, layout.table(CRASHES), CRASHES.table_schema)
    assert rows(loaded, "crash_record_id", "latitude") == [("c1", 41.5), ("c1", 41.75)]


def test_staged_prefix_load_matches_the_lazy_one(spark, tmp_path):
    layout = plans.Layout(str(tmp_path))
    pages = raw(spark, PERSONS, {0: [{}], 1: [{"person_id": "b", "vehicle_id": "x"}], 2: [{}]})
    assert plans.load_pages(pages, PERSONS, layout, "one", on_error="prefix") == 1
    staged = plans.stage_pages(pages, PERSONS)
    assert staged.count() == 3
    assert staged.filter(F.col(STATE) == KEPT).count() == 2
    assert ids(kept_pages(staged, PERSONS), PERSONS) == [(0, "O1")]
    report = spark.read.parquet(layout.report(PERSONS, "one"))
    assert rows(report) == [(0, 1, 1, False), (1, 1, 0, True), (2, 1, 0, False)]
    assert not list((tmp_path / "staged" / "persons").iterdir())


@pytest.mark.parametrize(
    "pages, first",
    [
        ({0: [{}], 1: [{"crash_record_id": "b", "latitude": None}], 2: [{}]}, None),
        ({0: [{}], 5: [{"crash_record_id": "b"}]}, 0),
        ({1: [{}]}, 0),
    ],
)
def test_page_that_cannot_be_used_fails_the_strict_load(spark, tmp_path, pages, first):
    frame = raw(spark, CRASHES, pages)
    with pytest.raises(ValueError, match="crashes: page [01] is missing, or none"):
        plans.clean_pages(frame, CRASHES, first_page=first)
    with pytest.raises(ValueError, match="is missing, or none"):
        plans.load_pages(frame, CRASHES, plans.Layout(str(tmp_path)), "one", first_page=first)
    assert plans.clean_pages(frame, CRASHES, "prefix", first).count() <= 1


def test_row_without_a_page_number_fails(spark):
    frame = raw(spark, CRASHES, {None: [{}], 1: [{}]})
    for mode in ("fail", "prefix"):
        with pytest.raises((PySparkException, Py4JJavaError), match="no page number"):
            plans.clean_pages(frame, CRASHES, mode).collect()


def test_same_load_id_keeps_what_is_loaded(spark, tmp_path):
    layout = plans.Layout(str(tmp_path))
    for key in ("a", "b"):
        pages = raw(spark, CRASHES, {0: [{"crash_record_id": key}]})
        plans.load_pages(pages, CRASHES, layout, "daily")
    loaded = read_table(spark, layout.table(CRASHES), CRASHES.table_schema)
    assert rows(loaded, "crash_record_id") == [("a",), ("b",)]


def test_two_loads_of_a_feed_at_once_do_not_share_files(spark, tmp_path):
    layouts = [plans.Layout(str(tmp_path)), plans.Layout(str(tmp_path))]

    def load(i):
        pages = raw(spark, VEHICLES, {0: [{"crash_unit_id": str(10 * i + k)} for k in range(5)]})
        return plans.load_pages(pages, VEHICLES, layouts[i], f"load{i}")

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(load, range(2))) == [5, 5]
    table = read_table(spark, layouts[0].table(VEHICLES), VEHICLES.table_schema)
    assert table.count() == 10


@pytest.mark.parametrize("limit, joins", [(0, False), (1, True)])
def test_rows_are_matched_once_with_many_repeated_keys(spark, tmp_path, monkeypatch, limit, joins):
    """More keys on several pages than the limit: the report and the merge read stored rows."""
    monkeypatch.setattr(feeds, "_MANY_REPEATS", limit, raising=False)
    plan, layout = {}, plans.Layout(str(tmp_path))

    def noted(step, place):
        inner = getattr(feeds, step)

        def run(*args, **named):
            plan[step] = plan_of(args[place])
            return inner(*args, **named)

        monkeypatch.setattr(feeds, step, run)

    noted("page_report", 1)
    noted("_merge", 0)
    two = [{}, {}, {"crash_record_id": "b"}]
    pages = raw(spark, CRASHES, {0: two, 1: [{"latitude": "9"}, {"crash_record_id": "c"}], 2: [{}]})
    assert plans.load_pages(pages, CRASHES, layout, "one") == 4
    assert {step: "LeftAnti" in text for step, text in plan.items()} == {"page_report": joins, "_merge": joins}
    loaded = read_table(spark, layout.table(CRASHES), CRASHES.table_schema)
    assert [r[0] for r in rows(loaded, "crash_record_id", "latitude")] == ["b", "c", "c1", "c1"]
    assert loaded.filter("latitude = 9").isEmpty()
    report = spark.read.parquet(layout.report(CRASHES, "one"))
    assert rows(report) == [(0, 3, 3, False), (1, 2, 1, False), (2, 1, 0, False)]
    assert not list((tmp_path / "staged" / "crashes").iterdir())


def test_feed_of_more_columns_than_bits(spark, monkeypatch):
    monkeypatch.setattr(feeds, "_BITS", 4, raising=False)
    pages = raw(spark, CRASHES, {0: [{"longitude": None}, {"latitude": None}], 1: [{"longitude": None}]})
    staged = plans.stage_pages(pages, CRASHES)
    assert "array" not in staged.drop(STATE).schema.simpleString()
    assert rows(feeds._hollow_fields(staged, CRASHES)) == [(1, "longitude")]
    assert ids(kept_pages(staged, CRASHES), CRASHES) == []


def test_views_show_the_next_load(spark, tmp_path):
    root = str(tmp_path)
    plans.full_refresh(spark, {"crashes": raw(spark, CRASHES, {0: [{}]})}, root, "one")
    assert spark.sql("select count(*) from stg_traffic_data").first()[0] == 1
    pages = raw(spark, CRASHES, {0: [{"crash_record_id": "c2"}]})
    plans.load_pages(pages, CRASHES, plans.Layout(root), "two")
    assert spark.sql("select count(*) from stg_traffic_data").first()[0] == 2


def test_key_form(spark, tmp_path):
    pages = raw(spark, CRASHES, {0: [{}]})
    keys = set()
    for n, form in enumerate((plans.KeyForm(), plans.KeyForm("|"), plans.KeyForm("", "+00"))):
        layout = plans.Layout(str(tmp_path / str(n)))
        plans.full_refresh(spark, {"crashes": pages}, layout.root, "one", keys=form)
        table = read_table(spark, layout.table(CRASHES), CRASHES.table_schema)
        keys.add(bytes(table.first()[ROW_KEY]))
    assert len(keys) == 3


def test_csv_entry(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = ",".join(["c9", "2023-09-05 19:05:00", "CLEAR", "", "OK", "x", "1", "41.5", "-87.5"])
    (tmp_path / "in" / "crashes.csv").write_text(",".join(CRASHES.column_names) + f"\n{line}\n")
    layout = plans.Layout(str(tmp_path / "mart"))
    plans.conform_csv(spark, str(tmp_path / "in"), CRASHES, layout)
    plans.load_conformed(spark, CRASHES, layout, "one")
    loaded = read_table(spark, layout.table(CRASHES), CRASHES.table_schema)
    assert rows(loaded, *CRASHES.column_names) == [
        ("c9", AT, "CLEAR", None, "OK", None, 1, 41.5, -87.5)
    ]


def test_full_refresh(spark, tmp_path):
    pages = {
        "crashes": raw(spark, CRASHES, {0: [{}, {"crash_record_id": "c2"}], 1: [{}]}),
        "vehicles": raw(spark, VEHICLES, {0: [{"make": ""}]}),
        "persons": raw(
            spark,
            PERSONS,
            {
                0: [{}, {"person_id": "O2", "person_type": "PASSENGER"}],
                1: [{"person_id": "O3", "age": None}, {"person_id": "O0", "safety_equipment": ""}],
            },
        ),
    }
    counts, models = plans.full_refresh(spark, pages, str(tmp_path), "one")
    assert counts == {"crashes": 2, "vehicles": 1, "persons": 4}
    fact = [("DRIVER", AT, "September", 2023, None, "CLEAR", "DAYLIGHT", "NO DEFECTS", 2, 0)]
    assert rows(models["fact_traffic_accidents"]) == fact
    assert rows(models["stg_vehicles_data"], "make") == [("PEDESTRAIN",)]
    assert models["age_distri"].count() == 2
    assert spark.sql("select count(*) from crashes_location").first()[0] == 2

    counts, models = plans.full_refresh(spark, {"persons": pages["persons"]}, str(tmp_path), "two")
    assert counts == {"persons": 4}
    assert rows(models["fact_traffic_accidents"]) == fact


def test_failed_feed_fails_the_refresh(spark, tmp_path):
    pages = {
        "crashes": raw(spark, CRASHES, {0: [{}]}),
        "vehicles": raw(spark, VEHICLES, {0: [{"vehicle_id": "x"}]}),
    }
    with pytest.raises((PySparkException, Py4JJavaError), match="not a whole number"):
        plans.full_refresh(spark, pages, str(tmp_path), "one")
    with pytest.raises(ValueError, match="boats"):
        plans.full_refresh(spark, {"boats": pages["crashes"]}, str(tmp_path), "one")


def test_models_of_a_mart_never_loaded_are_empty(spark, tmp_path):
    models = plans.publish_models(spark, plans.Layout(str(tmp_path)))
    assert len(models) == 6
    assert all(model.count() == 0 for model in models.values())


def test_publish_selected_models(spark, tmp_path):
    layout = plans.Layout(str(tmp_path))
    models = plans.publish_models(spark, layout, select=["age_distri", "stg_traffic_data"])
    assert sorted(models) == ["age_distri", "stg_traffic_data"]
    with pytest.raises(ValueError, match="nothing_such"):
        plans.publish_models(spark, layout, select=["nothing_such"])


def landed(folder, pages):
    """Pages of records as given: a missing key is a missing key."""
    for n, records in pages.items():
        path = folder / f"page_no={n}"
        path.mkdir(parents=True)
        (path / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(folder)


def without(record, *names, **changes):
    return {k: v for k, v in {**record, **changes}.items() if k not in names}


def sent_pages(spark, path, feed):
    return read_json_pages(spark, path, feed.column_names), read_sent_fields(spark, path, feed.column_names)


@pytest.mark.parametrize("on_error", ["fail", "prefix"])
def test_text_column_that_a_page_lacks(spark, tmp_path, on_error):
    pages = {
        # No record names it: the rows stay. Another column of the same page is null: they go.
        0: [without(CRASH, "road_defect", crash_record_id="a", injuries_total="x"), without(CRASH, "road_defect", crash_record_id="b")],
        # One record names it: the others are incomplete.
        1: [CRASH, without(CRASH, "road_defect", crash_record_id="c2")],
        # Named, but null on all rows: all are incomplete, and the page is no bad one.
        2: [{**CRASH, "crash_record_id": "c3", "road_defect": None}],
        # Two columns are absent; the row that lacks a third one is incomplete.
        3: [without(CRASH, "road_defect", "weather_condition", crash_record_id="d"),
            without(CRASH, "road_defect", "weather_condition", crash_record_id="e", lighting_condition=None)],
        4: [{**CRASH, "crash_record_id": "f"}],
    }
    raw_pages, sent = sent_pages(spark, landed(tmp_path / "landing", pages), CRASHES)
    got = plans.clean_pages(raw_pages, CRASHES, on_error, first_page=0, sent=sent)
    kept = rows(got, PAGE, "crash_record_id", "road_defect", "weather_condition", "injuries_total", "latitude")
    near = float(CRASH["latitude"])
    assert kept == [
        (0, "a", None, "CLEAR", 0, near),
        (0, "b", None, "CLEAR", 2, near),
        (1, "c1", "NO DEFECTS", "CLEAR", 2, near),
        (3, "d", None, None, 2, near),
        (4, "f", "NO DEFECTS", "CLEAR", 2, near),
    ]
    # Not knowing what the pages name, such rows are incomplete.
    plain = plans.clean_pages(raw_pages, CRASHES, on_error, first_page=0)
    assert rows(plain, "crash_record_id") == [("c1",), ("f",)]


@pytest.mark.parametrize("field", ["crash_record_id", "latitude", "crash_date"])
def test_read_column_that_a_page_lacks_or_has_null(spark, tmp_path, field):
    lacks = {0: [CRASH], 1: [without(CRASH, field)], 2: [{**CRASH, "crash_record_id": "z"}]}
    raw_pages, sent = sent_pages(spark, landed(tmp_path / "lacks", lacks), CRASHES)
    assert rows(plans.clean_pages(raw_pages, CRASHES, "prefix", sent=sent), "crash_record_id") == [("c1",)]
    with pytest.raises(ValueError, match="page 1"):
        plans.clean_pages(raw_pages, CRASHES, sent=sent)
    # Null on all rows is no error: the rows are incomplete, the load goes on.
    null = {0: [CRASH], 1: [{**CRASH, field: None}], 2: [{**CRASH, "crash_record_id": "z"}]}
    raw_pages, sent = sent_pages(spark, landed(tmp_path / "null", null), CRASHES)
    assert rows(plans.clean_pages(raw_pages, CRASHES, sent=sent), "crash_record_id") == [("c1",), ("z",)]


def test_report_and_errors_of_pages_that_lack_a_column(spark, tmp_path):
    pages = {
        0: [without(CRASH, "road_defect", crash_record_id=c) for c in "ab"],
        1: [without(CRASH, "road_defect", crash_record_id="c", latitude="north")],
        2: [CRASH],
    }
    raw_pages, sent = sent_pages(spark, landed(tmp_path / "landing", pages), CRASHES)
    layout = plans.Layout(str(tmp_path / "mart"))
    with pytest.raises((PySparkException, Py4JJavaError), match="not a number: north"):
        plans.load_pages(raw_pages, CRASHES, layout, "strict", sent=sent)
    assert plans.load_pages(raw_pages, CRASHES, layout, "one", "prefix", sent=sent) == 2
    report = spark.read.parquet(layout.report(CRASHES, "one"))
    assert rows(report) == [(0, 2, 2, False), (1, 1, 0, True), (2, 1, 0, False)]
    assert not list((tmp_path / "mart" / "staged" / "crashes").iterdir())


def test_fields_named_in_lines_arrays_and_file_names(spark, tmp_path):
    (tmp_path / "page-3.json").write_text(json.dumps([{"k": 1}, {"x": None, "other": 2}], indent=1))
    (tmp_path / "page-4.json").write_text("[]")
    (tmp_path / "page-5.json").write_text("<html>")
    got = read_sent_fields(spark, str(tmp_path), ["k", "x", "y"], "file_name", "array")
    assert rows(got) == [(3, "k"), (3, "x")]
    lines = spark.createDataFrame([(0, '{"k": {"x": 1}}'), (0, '[{"y": 1}, 5]'), (1, None), (1, "k")], "page_no long, b string")
    assert rows(sent_fields(lines, "b", ["k", "x", "y"])) == [(0, "k"), (0, "y")]
