import random
from datetime import datetime

import pytest
from helpers import rows, same, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_mart import operators as ops


def test_keep_columns_orders_and_fills(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    kept = ops.keep_columns(df, ["a", "c", "b"])
    assert kept.columns == ["a", "c", "b"]
    assert kept.first().c is None


def test_replace_columns_moves_them_last(spark):
    df = spark.createDataFrame([("m", "n", 1)], "make string, model string, unit int")
    done = ops.replace_columns(df, {"make": F.lit("x")})
    assert done.columns == ["model", "unit", "make"]


def test_assert_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert ops.assert_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="b"):
        ops.assert_columns(df, ["a", "b"])


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "x int, y string")
    assert rows(ops.drop_incomplete(df)) == [(1, "a")]
    assert rows(ops.drop_incomplete(df, ["y"]), "y") == [("a",), ("c",)]


def paged(spark, pages):
    data = [(n, key, i) for n, keys in pages.items() for i, key in enumerate(keys)]
    return spark.createDataFrame(data, "page_no bigint, key string, i int")


def test_first_page_wins_keeps_repeats_of_the_first_page(spark):
    df = paged(spark, {0: "aab", 1: "bcc", 2: "ad"})
    got = rows(ops.first_page_wins(df, "key", "page_no"), "page_no", "key")
    assert got == [(0, "a"), (0, "a"), (0, "b"), (1, "c"), (1, "c"), (2, "d")]


@pytest.mark.parametrize("seed", [1, 2])
def test_first_page_wins_by_brute_force(spark, seed):
    rng = random.Random(seed)
    # One key holds a third of the rows; NULL is a key like any other.
    keys = ["hot"] * 10 + [None] * 3 + [f"k{i}" for i in range(17)]
    pages = {n: [rng.choice(keys) for _ in range(40)] for n in range(12)}
    want, seen = [], set()
    for n, page in pages.items():
        want += [(n, k, i) for i, k in enumerate(page) if k not in seen]
        seen |= set(page)
    df = paged(spark, pages)
    assert same(ops.first_page_wins(df, "key", "page_no"), want)
    repeats = ops.repeated_keys(df, "key", "page_no")
    for hot_rows in (20, 10_000):
        assert same(ops.drop_later_pages(df, repeats, "key", "page_no", hot_rows), want)


def test_repeated_keys(spark):
    df = paged(spark, {0: "aab", 1: "bcc", 2: "bd"})
    assert rows(ops.repeated_keys(df, "key", "page_no")) == [("b", 0, 3)]


def prefix(spark, numbers, bad, first=None):
    df = spark.createDataFrame([(n, n in bad) for n in numbers], "page_no bigint, broken boolean")
    ledger = ops.page_ledger(df, "page_no", F.col("broken"))
    return values(ops.page_prefix(df, ledger, "page_no", first), "page_no")


def test_page_prefix_stops_at_first_bad_page(spark):
    assert prefix(spark, range(5), {2, 4}) == [0, 1]
    assert prefix(spark, range(5), set()) == [0, 1, 2, 3, 4]
    assert prefix(spark, [0, 1, 3], set()) == [0, 1, 3]


def test_page_prefix_stops_at_first_gap(spark):
    assert prefix(spark, [0, 1, 3, 4], set(), first=0) == [0, 1]
    assert prefix(spark, [1, 2], set(), first=0) == []
    assert prefix(spark, [0, 1, 2, 3], {1}, first=0) == [0]
    assert prefix(spark, [0, 1, 2, 4], {3, 4}, first=1) == [1, 2]
    assert prefix(spark, [3, 3, 4], set(), first=3) == [3, 3, 4]


def test_page_ledger_needs_a_flag_once_per_page(spark):
    df = spark.createDataFrame(
        [(0, "a"), (0, None), (1, None), (1, None)], "page_no bigint, x string"
    )
    ledger = ops.page_ledger(df, "page_no", F.lit(False), [F.col("x").isNotNull()])
    assert rows(ledger) == [(0, False), (1, True)]


def test_rows_kept(spark):
    df = paged(spark, {0: "ab", 2: "c"})
    assert rows(ops.rows_kept(df, "page_no")) == [(0, 2), (2, 1)]


def test_latest_per_group_breaks_ties_low(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("g", at, "p2"), ("g", at, "p1"), ("g", None, "p0"), ("h", None, "p9")],
        "g string, t timestamp, p string",
    )
    assert rows(ops.latest_per_group(df, ["g"], "t", ["p"]), "g", "p") == [("g", "p1"), ("h", "p9")]


def test_latest_per_group_by_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaaaabcde"), rng.randrange(20), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, t int, i int").repartition(5)
    want = {g: min((-t, i) for h, t, i in data if h == g) for g, _, _ in data}
    got = {r.g: (-r.t, r.i) for r in ops.latest_per_group(df, ["g"], "t", ["i"]).collect()}
    assert got == want


def test_join_keeps_fan_out(spark):
    left = spark.createDataFrame([("c", 1)], "k string, x int")
    right = spark.createDataFrame([("c", 10), ("c", 11), ("d", 12)], "k string, y int")
    assert rows(ops.join_on_key(left, right, "k", ["x"], ["y"])) == [(1, 10), (1, 11)]


@pytest.mark.parametrize("hot_rows", [0, 1, 100])
def test_unmatched_rows(spark, hot_rows):
    source = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, x string"
    ).repartition(3)
    target = spark.createDataFrame([(1,), (None,), (1,)], "k int")
    got = ops.unmatched_rows(source, target, "k", hot_rows)
    assert got.columns == ["k", "x"]
    assert rows(got) == sorted([(2, "b"), (2, "c"), (None, "d")], key=repr)


@pytest.mark.parametrize("hot_rows", [50, 1000])
def test_unmatched_rows_by_brute_force_with_hot_keys(spark, hot_rows):
    rng = random.Random(5)
    # New key 7 and old key 3 fill much of the source, key 3 a third of the target.
    source = [(rng.choice([7] * 10 + [3] * 10 + list(range(20))), i) for i in range(900)]
    target = [(rng.choice([3] * 10 + list(range(0, 20, 3))),) for _ in range(300)]
    got = ops.unmatched_rows(
        spark.createDataFrame(source, "k int, i int").repartition(6),
        spark.createDataFrame(target, "k int").repartition(6),
        "k",
        hot_rows,
    )
    old = {k for (k,) in target}
    assert rows(got) == sorted((r for r in source if r[0] not in old), key=repr)


def test_key_status_holds_new_and_hot_keys(spark):
    source = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    target = spark.createDataFrame([(1,), (2,), (1,)], "k int")
    assert rows(ops.key_status(source, target, "k", 1)) == [(1, 2, False), (3, 1, True)]
    assert rows(ops.key_status(source, target, "k")) == [(3, 1, True)]


def test_merged_never_updates(spark):
    target = spark.createDataFrame([(1, "old")], "k int, x string")
    source = spark.createDataFrame([(1, "new"), (2, "new")], "k int, x string")
    assert rows(ops.merged(source, target, "k")) == [(1, "old"), (2, "new")]


def test_sample_rows(spark):
    df = spark.range(50)
    assert ops.sample_rows(df, None) is df
    assert ops.sample_rows(df, 7).count() == 7
    assert values(ops.sample_rows(df, 3, ["id"]), "id") == [0, 1, 2]


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    got = ops.schema_contract(df, [("a", "bigint"), ("b", "int"), ("c", "string")])
    assert rows(got, "column", "actual", "ok") == [
        ("a", "bigint", True),
        ("b", "string", False),
        ("c", None, False),
    ]


def test_contract_report(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    got = ops.contract_report(df, [("a", "bigint"), ("b", "string"), ("c", "int")], ["a", "b"])
    assert rows(got, "column", "rows", "nulls", "ok") == [
        ("a", 2, 0, True),
        ("b", 2, 1, False),
        ("c", 2, 2, False),
    ]


def test_required(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert rows(ops.required(df, ["a"])) == [(1, None)]
    with pytest.raises(PySparkException, match="b is required"):
        ops.required(df, ["b"]).collect()
