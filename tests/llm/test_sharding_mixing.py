import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_mart.llm import common, mixing, virtual_slots

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASH = ("cell", "m", "n", "content_hash", "row_hash", "shard", "shards", "size", "first", "draws", "known", "row", "copy", "seat")


def documents(spark, rows, extra=()):
    schema = DOCS + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) + ("x",) * len(extra) for i, t, s in rows], schema)


def plain(n=200, sources=4):
    return [(i, "w " * (1 + i * 7 % 50), f"s{i % sources}") for i in range(n)]


def test_targets_stop_at_the_cap_and_are_shared_anew():
    got = mixing.targets([10, 100, 100], [5, 2, 1], 1.5, 2)
    assert got[0] == 20 and abs(sum(got) - 315) < 1e-9
    assert abs(got[1] - min(200, 295 * 2 / 3)) < 1e-9
    assert mixing.targets([], [], 1.5, 2) == []
    assert mixing.targets([0, 0], [5, 2], 1.5, 2) == [0, 0]


def test_split_quotas_are_exact():
    quotas = np.array([100, 0, 7, 1])
    out = mixing.split_quotas(quotas, 5, 3)
    assert (out.sum(axis=0) == quotas).all()
    assert out.sum(axis=1).max() - out.sum(axis=1).min() <= 1
    assert (out == mixing.split_quotas(quotas, 5, 3)).all()


def test_blocks_come_near_any_target():
    words = np.arange(1, 60)
    for target in (0, 1, 17.5, 900, 1770, 2000.4, 3540):
        copies = mixing.choose_blocks(words, np.random.default_rng(1).permutation(59), target)
        assert abs((copies * words).sum() - target) <= 3 and copies.max(initial=0) <= 2


def test_mix_report(spark):
    rows = plain() + [(900, None, None), (901, "", "s0"), (902, "a b\x0bc", None)]
    got = mixing.mix_report(documents(spark, rows, CLASH)).toPandas()
    assert len(got) == len(rows)
    by_id = got.set_index("doc_id")
    assert by_id.loc[900, "size"] == 0 and by_id.loc[902, "size"] == 2
    assert (got.taken <= 2 * got["size"]).all() and (got.taken % got["size"].where(got["size"] > 0, 1) == 0).all()
    for _, g in got.groupby("target"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 2
    again = mixing.mix_report(documents(spark, rows)).toPandas().set_index("doc_id")
    assert (again.taken.sort_index() == by_id.taken.sort_index()).all()


def test_mix_report_with_a_repeated_row(spark):
    rows = [(1, "same words here", "hot")] * 600 + plain(100, 2)
    got = mixing.mix_report(documents(spark, rows)).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("target"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 30


def test_mix_documents_equals_its_report(spark):
    docs = documents(spark, plain() + [(900, None, None)], CLASH)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    report = {r.doc_id: len(r.shards) for r in mixing.mix_report(docs).collect()}
    assert counts == {k: v for k, v in report.items() if v}


def splits(docs, n):
    """The same rows in another order and number of partitions."""
    return docs.repartition(n, "n_chars") if n % 2 else docs.repartition(n)


def test_results_do_not_depend_on_splits(spark):
    docs = documents(spark, [(1, "same words here", "s2")] * 3000 + plain(500, 3) + [(None, None, None)] * 2)

    def rows(df):
        return sorted(map(repr, df.collect()))

    mixes = [rows(mixing.mix_report(splits(docs, n))) for n in (4, 8, 31)]
    assert mixes[0] == mixes[1] == mixes[2] and len(mixes[0]) == 3502
    shards = [rows(virtual_slots.shard_documents(splits(docs, n))) for n in (4, 8, 31)]
    assert shards[0] == shards[1] == shards[2] and len(shards[0]) == 3502
    texts = [rows(mixing.mix_documents(splits(docs, n))) for n in (4, 31)]
    assert texts[0] == texts[1]


def test_spread_deals_copies_round(spark):
    groups = spark.createDataFrame([(5, 1), (5, 3), (-2, 8), (2**63 - 1, 21)], "content_hash long, n long")
    for first in (0, 6):
        got = {}
        for r in common.spread(groups.withColumn("of", F.col("n")), 8, F.lit(first)).collect():
            got.setdefault(r.of, {})[r.cell] = r.m
        for h, n in ((5, 1), (5, 3), (-2, 8), (2**63 - 1, 21)):
            want = Counter((h + first + k) % 8 for k in range(n))
            assert got[n] == want


def test_mix_documents_keeps_rows_that_differ_elsewhere(spark):
    rows = [(1, "some words here", "en", "a", i // 3) for i in range(300)] + [(2, "x", "en", "b", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    report = mixing.mix_report(docs).where("doc_id = 1").collect()
    mixed = mixing.mix_documents(docs).where("doc_id = 1").collect()
    assert len(mixed) == sum(len(r.shards) for r in report)
    # Three equal rows, each drawn once or twice: none is lost while others are drawn twice as often.
    counts = Counter(r.n_chars for r in mixed)
    assert len(report) == 300 and all(n <= 6 for n in counts.values())
    if all(len(r.shards) >= 1 for r in report):
        assert set(counts) == set(range(100)) and min(counts.values()) >= 3


def test_a_stored_map_is_edited(spark, tmp_path):
    path = str(tmp_path / "maps")
    docs = documents(spark, plain(600) + [(7, "again", "s")] * 5000)
    assert virtual_slots.SlotMap.load(spark, path) is None
    one = virtual_slots.shard_documents(docs, 6, path).toPandas()
    known = virtual_slots.SlotMap.load(spark, path)
    assert known.version == one.map_version.iloc[0] and virtual_slots.SlotMap.load(spark, path, 1).version == 1
    again = virtual_slots.shard_documents(docs, 6, path).toPandas()
    order = ["shard", "slot"]
    assert again.sort_values(order, ignore_index=True).equals(one.sort_values(order, ignore_index=True))
    more = docs.unionByName(documents(spark, [(5000 + i, "long text " * 400, "s") for i in range(40)]))
    two = virtual_slots.shard_documents(more, 6, path).toPandas()
    edited = virtual_slots.SlotMap.load(spark, path)
    assert edited.version == known.version + 1
    moved = {s for s in range(virtual_slots.SLOTS) if edited.shard_of[s] != known.shard_of[s]}
    assert moved
    old, new = (x[["virtual_slot", "shard"]].drop_duplicates().set_index("virtual_slot").shard for x in (one, two))
    assert {s for s in old.index if old[s] != new[s]} == moved & set(old.index)
    # Old records keep their slots.
    key = ["doc_id", "virtual_slot"]
    assert Counter(map(tuple, one[key].values)) == Counter(map(tuple, two[two.doc_id < 5000][key].values))
    # A version whose write was cut off does not count.
    edited.frame(spark).limit(9).withColumn("version", F.lit(99)).write.parquet(f"{path}/map-000000099")
    assert virtual_slots.SlotMap.load(spark, path) == edited
    with pytest.raises(ValueError):
        virtual_slots.shard_documents(docs, 7, path)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert mixing.mix_report(none).count() == 0
    assert mixing.mix_documents(none).count() == 0
    assert virtual_slots.shard_documents(none).count() == 0


def test_shards_are_even_and_gapless(spark):
    rows = plain(400) + [(7, None, "s"), (None, "x", "s"), (None, "x", "s")] + [(5, "again", "s")] * 300
    got = virtual_slots.shard_documents(documents(spark, rows, CLASH), 6).toPandas()
    assert len(got) == len(rows) and set(got.law) == {"bytes"}
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 6 and loads.max() - loads.min() <= 0.05 * loads.mean()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert ((got.next_shard == got.shard) | (got.next_shard == 6)).all()
    text = {i: t for i, t, _ in rows[:400]}
    for r in got[got.doc_id.isin([0, 1, 2, 399])].itertuples():
        body = text[r.doc_id].encode()
        assert r.size == len(body) + 8 and r.text_crc32 == zlib.crc32(body)


@pytest.mark.parametrize("weights", [[0] * 8, [1] * 8, [100, 1, 1, 1, 1, 1, 1, 1], list(range(8))])
def test_slot_map_versions(weights):
    first = virtual_slots.SlotMap.first(weights, 3)
    balanced = first.balanced()
    grown = balanced.grown()
    assert (first.version, balanced.version, grown.version) == (1, 2, 3)

    def loads(m):
        return [sum(w for w, s in zip(weights, m.shard_of) if s == k) for k in range(m.n_shards)]

    changed = balanced.weighed([w + 5 * (i % 3) for i, w in enumerate(weights)]).balanced()
    assert changed.version == 3
    spread = max(loads(balanced)) - min(loads(balanced))
    assert spread <= max(loads(first)) - min(loads(first))
    assert all(a == b or b == 3 for a, b in zip(balanced.shard_of, grown.shard_of))
