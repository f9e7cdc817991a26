import math
import random

import numpy as np
import pytest

from incident_mart.llm import components, int8_tiles, pivot_topk

VECTORS = "vec_id long, embedding array<float>, label int, cell string, links string, pivots string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], VECTORS)


def clustered(n, dim, seed, noise=0.08, groups=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    out = []
    for i in range(n):
        v = centres[i % groups] + noise * (1 + i % 4) * rng.normal(size=dim) if i % 2 else rng.normal(size=dim)
        out.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.1, 9)]))
    return out


ODD = [
    (5000, None),
    (5001, [0.0] * 16),
    (5002, [float("nan")] + [1.0] * 15),
    (5003, [float("inf")] + [1.0] * 15),
    (5004, [None] + [1.0] * 15),
    (5005, []),
    (5006, [1.0] * 15),
    (5007, [2.0] * 15),
    (5008, [1e-30] * 16),
    (5009, [1e30] * 16),
    (5010, [1.0] * 16),
    (5010, [1.0] * 16),
]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute_links(rows, threshold=0.95):
    n = len(rows)
    links = [set() for _ in range(n)]
    unit = [np.array(v, float) / np.abs(v).max() if usable(v) else None for _, v in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]):
                cos = unit[i] @ unit[j] / (np.linalg.norm(unit[i]) * np.linalg.norm(unit[j]))
                if cos >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        out.append((rows[i][0], len(links[i]), min(rows[k][0] for k in seen)))
    return sorted(out)


@pytest.mark.parametrize("tile_rows, rows_per_centre", [(4096, 16384), (40, 30), (17, 400)])
def test_links_equal_brute_force(spark, tile_rows, rows_per_centre):
    rows = clustered(330, 16, 3) + ODD + [(6000 + i, clustered(330, 16, 3)[1][1]) for i in range(20)]
    got = int8_tiles.near_duplicates(frame(spark, rows), 0.95, tile_rows, rows_per_centre).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert max(r.n_links for r in got) > 20


def test_bounds_hold_near_the_threshold():
    rng = np.random.default_rng(5)
    a = int8_tiles.unit(rng.normal(size=(900, 24)))
    b = int8_tiles.unit(a + rng.normal(size=a.shape) * 0.33 * np.abs(a).mean())
    cosines = a @ b.T
    tiles = int8_tiles.quantised(a), int8_tiles.quantised(b)
    assert tiles[0].codes.dtype == np.int8
    for threshold in (0.9, 0.93, 0.95, 0.97):
        found, sure_ones = set(), set()
        for i, j, sure in int8_tiles.near_pairs(*tiles, False, threshold):
            met = set(zip(i.tolist(), j.tolist()))
            assert not met & found
            found |= met
            sure_ones |= set(zip(i[sure].tolist(), j[sure].tolist()))
        links = set(zip(*map(np.ndarray.tolist, np.nonzero(cosines >= threshold))))
        assert sure_ones <= links <= found and len(found) < 3 * len(links) + 900


def test_what_is_said_of_a_pair_depends_on_its_rows_alone():
    rng = np.random.default_rng(8)
    centre = rng.normal(size=32)
    tile = int8_tiles.quantised(int8_tiles.unit(centre + 0.23 * rng.normal(size=(700, 32))))

    def said(order):
        out = {}
        for i, j, sure in int8_tiles.near_pairs(tile.of(order), tile.of(order), True, 0.95):
            out |= {frozenset((order[x], order[y])): z for x, y, z in zip(i, j, sure.tolist(), strict=True)}
        return out

    whole = said(np.arange(700))
    some = rng.permutation(700)[:400]
    inside = set(some.tolist())
    assert said(some) == {pair: sure for pair, sure in whole.items() if pair <= inside}
    assert 0 < sum(whole.values()) < len(whole)


def test_links_at_the_threshold_in_a_dense_group(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=12)
    rows = [(i, [float(np.float32(x)) for x in centre + 0.2 * rng.normal(size=12)]) for i in range(240)]
    want = brute_links(rows)
    for options in ((4096, 16384), (50, 60)):
        got = int8_tiles.near_duplicates(frame(spark, rows), 0.95, *options).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert 20 < np.mean([n for _, n, _ in want]) < 230


def test_no_vectors(spark):
    assert int8_tiles.near_duplicates(frame(spark, [])).count() == 0
    assert pivot_topk.top_k(frame(spark, [])).count() == 0
    only_bad = frame(spark, ODD[:5])
    assert int8_tiles.near_duplicates(only_bad).count() == 5
    assert pivot_topk.top_k(only_bad).count() == 0


@pytest.mark.parametrize("q, c", [(512, 8192), (3, 25)])
def test_top_k_equals_brute_force(spark, q, c):
    rows = clustered(260, 16, 9) + [(1000 + i, clustered(260, 16, 9)[50][1]) for i in range(8)]
    rows += [x for x in ODD if x[0] not in (5008, 5009)] + [(None, [1.0] * 16), (5050, [-1.0] * 15)]
    got = pivot_topk.top_k(frame(spark, rows), query_rows=q, candidate_rows=c).collect()
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * np.float32(x).astype(float)) for x in v]
    want = []
    for i, v in good.items():
        if i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), k) for k, w in good.items() if k != i and len(w) == len(v)]
            want += [(i, rank + 1, k, -s) for rank, (s, k) in enumerate(sorted(scores)[:5])]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def plain_top_k(rows, k=5):
    """Every row is a query or a candidate, repeats too."""
    whole = [(i, [math.floor(256 * np.float32(x).astype(float)) for x in v]) for i, v in rows]
    want = []
    for i, v in whole:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)
            want += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(want)


def test_scores_of_large_components_are_exact(spark):
    rng = np.random.default_rng(11)
    rows = [(50, [1.0, 1.0]), (1, [600000.0, 0.0]), (2, [700000.0, 0.0])]
    rows += [(100 + i, [float(x) for x in rng.integers(-(10**6), 10**6, 2)]) for i in range(60)]
    # Beyond double precision, and with partial sums beyond a long.
    wide = [(50 * i, [float(x) for x in rng.normal(size=2) * 5e6]) for i in range(20)]
    vast = [(0, [1.1e7, 1.1e7]), (1, [1e7, -1e7]), (2, [1.05e7, -1e7]), (3, [9e6, 1.0])]
    for listed in (rows, wide, vast):
        got = pivot_topk.top_k(frame(spark, listed), query_rows=7, candidate_rows=9).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == plain_top_k(listed)


def test_scores_that_fit_no_long_are_errors(spark):
    for rows in ([(0, [1e30, -1e30]), (1, [1e30, 1.0])], [(0, [1e8, 1e8]), (1, [1e8, 1e8])]):
        with pytest.raises(Exception, match="does not fit a long"):
            pivot_topk.top_k(frame(spark, rows)).collect()


def test_sums_by_size():
    rng = np.random.default_rng(3)
    for most in (10**3, 10**8, 10**9, 2**62):
        rows = rng.integers(-most, most, (40, 5))
        ids, own = np.arange(40), np.array([3])
        gaps = np.abs(rows[:, :1].astype(float) - rows[3, :1])
        best, scores = next(pivot_topk.search(rows[3:4], gaps[3:4] * 0, rows, gaps * 0, ids, own, 5))
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(rows[3], r)), i) for i, r in enumerate(rows) if i != 3)
        assert [(-int(s), int(i)) for s, i in zip(scores, best)] == exact[:5]


@pytest.mark.parametrize("candidate_rows", [8192, 5])
def test_repeated_vectors_count_as_often_as_they_occur(spark, candidate_rows):
    near = clustered(60, 8, 2)
    rows = near + [near[7]] * 9 + [near[50]] * 2 + [near[9]]
    got = pivot_topk.top_k(frame(spark, rows), candidate_rows=candidate_rows).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == plain_top_k(rows)


def test_components_of_random_graphs(spark):
    random.seed(4)
    for n, m in ((60, 40), (200, 150), (40, 0)):
        pairs = [(random.randrange(n), random.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1012)]
        root = {x: x for p in pairs for x in p}
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                low = min(root[a], root[b])
                changed |= root[a] != low or root[b] != low
                root[a] = root[b] = low
        links = spark.createDataFrame(pairs, "u long, v long")
        for one_task in (0, 10**6):
            got = components.connected_components(links, one_task).collect()
            assert {r.node: r.component for r in got} == root and len(got) == len(root)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
