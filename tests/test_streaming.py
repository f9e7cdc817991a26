import json

import pytest
from helpers import rows
from test_feeds import PERSON

from incident_mart import plans
from incident_mart.schemas import PERSONS, schema_of
from incident_mart.sources import read_table
from incident_mart.streaming import (
    PullLoad,
    close_pull,
    merge_stream,
    pull_outcomes,
    retry_set_aside,
    set_aside_pulls,
    start_feed_stream,
)
from incident_mart.streaming.pulls import is_data_error


def land(folder, page, ids, **changes):
    path = folder / f"page_no={page}"
    path.mkdir(parents=True)
    lines = [json.dumps({**PERSON, "person_id": i, **changes}) for i in ids]
    (path / "a.json").write_text("\n".join(lines) + "\n")


def run(spark, tmp_path, **options):
    query = start_feed_stream(
        spark,
        PERSONS,
        str(tmp_path / "landing"),
        str(tmp_path / "mart"),
        str(tmp_path / "checkpoint"),
        **options,
    )
    query.awaitTermination()
    path = plans.Layout(str(tmp_path / "mart")).table(PERSONS)
    return rows(read_table(spark, path, PERSONS.table_schema), "person_id")


def test_feed_stream_loads_only_new_pages(spark, tmp_path):
    land(tmp_path / "landing", 0, ["a", "a", "b"])
    land(tmp_path / "landing", 1, ["b", "c"])
    assert run(spark, tmp_path) == [("a",), ("a",), ("b",), ("c",)]
    assert run(spark, tmp_path) == [("a",), ("a",), ("b",), ("c",)]
    land(tmp_path / "landing", 2, ["a", "d"])
    assert run(spark, tmp_path) == [("a",), ("a",), ("b",), ("c",), ("d",)]


def test_feed_stream_one_pull_at_a_time(spark, tmp_path):
    """Repeats differ in a hash column: the rows of a pull depend on its pages alone."""
    closed = str(tmp_path / "closed")
    for pull in range(2):
        for page, ids in enumerate(["ab", "bc", "cd"]):
            land(tmp_path / "landing" / f"p{pull}", page, ids, vehicle_id=str(10 * pull + page))
        close_pull(spark, closed, f"p{pull}")
    (tmp_path / "landing" / "open").mkdir()
    want = [(i, str(10 * pull + page)) for page, i in ((0, "a"), (0, "b"), (1, "c"), (2, "d")) for pull in (0, 1)]
    run(spark, tmp_path, max_files=1, closed=closed)
    path = plans.Layout(str(tmp_path / "mart")).table(PERSONS)
    assert rows(read_table(spark, path, PERSONS.table_schema), "person_id", "vehicle_id") == sorted(want)


def test_batches_of_a_pull_are_refused(spark, tmp_path):
    for option in ({"max_files": 1}, {"every": "1 second"}):
        with pytest.raises(ValueError, match="closed"):
            run(spark, tmp_path, **option)


def test_stream_goes_on_after_a_bad_page(spark, tmp_path):
    land(tmp_path / "landing", 0, ["a"])
    land(tmp_path / "landing", 1, ["b"], vehicle_id="x")
    assert run(spark, tmp_path, on_error="prefix") == [("a",)]
    land(tmp_path / "landing", 2, ["c"])
    assert run(spark, tmp_path, on_error="prefix") == [("a",), ("c",)]


def test_second_checkpoint_deletes_nothing(spark, tmp_path):
    land(tmp_path / "landing", 0, ["a", "b"])
    assert run(spark, tmp_path) == [("a",), ("b",)]
    land(tmp_path / "other", 0, ["c"])
    query = start_feed_stream(
        spark, PERSONS, str(tmp_path / "other"), str(tmp_path / "mart"), str(tmp_path / "checkpoint2")
    )
    query.awaitTermination()
    path = plans.Layout(str(tmp_path / "mart")).table(PERSONS)
    assert rows(read_table(spark, path, PERSONS.table_schema), "person_id") == [("a",), ("b",), ("c",)]


def test_batch_run_again_leaves_rows_once(spark, tmp_path):
    """A new checkpoint repeats batch 0, as a failure after the write would."""
    schema = schema_of([("k", "bigint"), ("x", "string")])
    table, source = str(tmp_path / "t"), str(tmp_path / "in")
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], schema).write.parquet(source)
    for attempt in range(2):
        stream = spark.readStream.schema(schema).parquet(source)
        query = merge_stream(stream, table, schema, str(tmp_path / f"c{attempt}"), "s", key="k")
        query.awaitTermination()
    assert rows(read_table(spark, table, schema)) == [(1, "a"), (2, "b"), (2, "c")]


def test_stream_that_keeps_looking(spark, tmp_path):
    schema = schema_of([("k", "bigint")])
    source = str(tmp_path / "in")
    spark.createDataFrame([(1,)], schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    query = merge_stream(
        stream, str(tmp_path / "t"), schema, str(tmp_path / "c"), "s", key="k", every="1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert rows(read_table(spark, str(tmp_path / "t"), schema)) == [(1,)]


def person_ids(spark, tmp_path):
    path = plans.Layout(str(tmp_path / "mart")).table(PERSONS)
    return rows(read_table(spark, path, PERSONS.table_schema), "person_id")


def test_bad_pull_is_set_aside_and_loaded_once_mended(spark, tmp_path):
    closed = str(tmp_path / "closed")
    for pull, bad in (("p0", False), ("p1", True), ("p2", False)):
        land(tmp_path / "landing" / pull, 0, [f"{pull}-a", f"{pull}-b"])
        land(tmp_path / "landing" / pull, 1, [f"{pull}-c"], vehicle_id="none" if bad else "7")
        close_pull(spark, closed, pull)
    want = [(f"{p}-{i}",) for p in ("p0", "p2") for i in "abc"]
    assert run(spark, tmp_path, closed=closed, set_aside=True, max_files=1) == want
    root = str(tmp_path / "mart")
    told = {r.pull: r for r in pull_outcomes(spark, PERSONS, root).collect()}
    assert {p: r.outcome for p, r in told.items()} == {"p0": "loaded", "p1": "set aside", "p2": "loaded"}
    assert "not a whole number: none" in told["p1"].reason and told["p1"].rows_merged == 0
    assert told["p0"].rows_merged == 3
    report = spark.read.parquet(plans.Layout(root).report(PERSONS, "persons-stream-p1"))
    assert rows(report) == [(0, 2, 0, False), (1, 1, 0, True)]

    how = PullLoad(PERSONS, str(tmp_path / "landing"), root)
    assert retry_set_aside(spark, how) == {"p1": "set aside"}
    page = tmp_path / "landing" / "p1" / "page_no=1" / "a.json"
    page.write_text(page.read_text().replace('"none"', '"7"'))
    (page.parent / ".a.json.crc").unlink(missing_ok=True)
    assert retry_set_aside(spark, how) == {"p1": "loaded"}
    assert retry_set_aside(spark, how) == {} and set_aside_pulls(spark, PERSONS, root) == []
    assert person_ids(spark, tmp_path) == sorted([*want, ("p1-a",), ("p1-b",), ("p1-c",)])


def test_bad_pull_ends_the_stream_unless_set_aside(spark, tmp_path):
    closed = str(tmp_path / "closed")
    land(tmp_path / "landing" / "p0", 0, ["a"], vehicle_id="none")
    close_pull(spark, closed, "p0")
    with pytest.raises(Exception, match="not a whole number"):
        run(spark, tmp_path, closed=closed)
    with pytest.raises(ValueError, match="closed"):
        run(spark, tmp_path, set_aside=True)
    assert pull_outcomes(spark, PERSONS, str(tmp_path / "mart")).count() == 0


def test_a_pull_with_a_gap_is_set_aside(spark, tmp_path):
    closed = str(tmp_path / "closed")
    land(tmp_path / "landing" / "p0", 0, ["a"])
    land(tmp_path / "landing" / "p0", 2, ["b"])
    land(tmp_path / "landing" / "p1", 0, ["c"])
    close_pull(spark, closed, "p0")
    close_pull(spark, closed, "p1")
    assert run(spark, tmp_path, closed=closed, set_aside=True, first_page=0) == [("c",)]
    assert set_aside_pulls(spark, PERSONS, str(tmp_path / "mart")) == ["p0"]


def test_errors_that_are_not_of_the_data(spark):
    assert is_data_error(ValueError("page 3 is missing"))
    assert not is_data_error(OSError("no space left"))
    with pytest.raises(Exception) as lost:
        spark.read.parquet("/no/such/folder").collect()
    assert not is_data_error(lost.value)
    with pytest.raises(Exception) as bad:
        spark.sql("select raise_error('x')").collect()
    assert is_data_error(bad.value)


def test_pull_without_a_text_column_keeps_its_rows(spark, tmp_path):
    closed = str(tmp_path / "closed")
    path = tmp_path / "landing" / "p0" / "page_no=0"
    path.mkdir(parents=True)
    record = {k: v for k, v in PERSON.items() if k != "sex"}
    (path / "a.json").write_text(json.dumps(record) + "\n")
    close_pull(spark, closed, "p0")
    assert run(spark, tmp_path, closed=closed) == [("O1",)]


def test_files_are_archived_and_no_row_is_lost(spark, tmp_path):
    """A file moves away once the batch after its own is planned; what is left is read once."""
    archive = tmp_path / "archive"
    options = {"archive": str(archive), "max_file_age": "30d"}
    ids = []
    for page in range(4):
        land(tmp_path / "landing", page, [f"k{page}", f"l{page}"])
        ids += [(f"k{page}",), (f"l{page}",)]
        assert run(spark, tmp_path, **options) == sorted(ids)
    moved = sorted(p.parent.name for p in archive.rglob("*.json"))
    left = sorted(p.parent.name for p in (tmp_path / "landing").rglob("*.json"))
    assert len(moved) >= 2 and sorted(moved + left) == [f"page_no={n}" for n in range(4)]
