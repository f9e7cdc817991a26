import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from incident_mart.llm import common, probminhash

DOCS = "doc_id long, text string, row string, bands string, node string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
    return {k: 1 + math.log(n) for k, n in Counter(found).items()}


def jaccard(x, y):
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in x.keys() & y.keys())


def brute_classes(rows, threshold=0.8):
    sets = [shingles(t) if i is not None else {} for i, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return [low.get(find(i)) for i in range(len(rows))]


def corpus(seed=1):
    random.seed(seed)
    word = lambda: f"w{random.randrange(400)}"
    texts = []
    for _ in range(12):
        base = [word() for _ in range(120)]
        texts.append(" ".join(base))
        for edits in (1, 1, 2, 3, 4, 8):  # around the threshold, and chains of copies
            copy = list(base)
            for _ in range(edits):
                copy[random.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            base = copy if edits == 2 else base
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(90)) for _ in range(15)]
    texts += ["one two three", "one two three", "one two", "a b c d e", "a b c  d\te", "", None, " \n", "", "x " * 300, "x " * 400]
    return [(i * 7 % 1000, t) for i, t in enumerate(texts)]


def test_classes_equal_brute_force(spark):
    rows = corpus() + [(None, "a b c d e"), (3, corpus()[0][1]), (3, corpus()[0][1])]
    got = probminhash.classes(probminhash.numbered(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = Counter((i, c) for (i, _), c in zip(rows, brute_classes(rows)))
    assert Counter((r.doc_id, r.class_id) for r in got) == want
    blank = {i for i, t in rows if not (t or "").strip()}
    kept = Counter(r.class_id for r in got if r.kept and r.class_id is not None)
    assert kept.keys() == {r.class_id for r in got} - {None}
    assert all(n == 1 for c, n in kept.items() if c not in blank)


def test_one_of_each_class_stays(spark):
    rows = [(5, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (9, "other words are in this one"), (7, None), (8, None)]
    docs = frame(spark, rows)
    left = probminhash.without_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 7, 8, 9]


def test_buckets_of_many_members(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "SMALL", 2)
    monkeypatch.setattr(probminhash, "HUBS", 1)
    rows = corpus(4)
    got = probminhash.near_duplicates(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, c) for (i, _), c in zip(rows, brute_classes(rows)))


def at_threshold(unions):
    """Pairs with 4 of 5 shingles in common, all of weight 1, in the order of ids."""
    texts = []
    for union in unions:
        same = [f"u{union}x{i}" for i in range(union * 4 // 5 + 4)]
        texts += [" ".join(same), " ".join(same + [f"u{union}y{i}" for i in range(union // 5)])]
    return list(enumerate(texts))


def test_pairs_at_the_threshold_are_near(spark):
    rows = at_threshold([10, 15, 60, 65, 75, 80, 85, 100, 105, 500])
    for (_, a), (_, b) in zip(rows[::2], rows[1::2]):
        x, y = shingles(a).keys(), shingles(b).keys()
        assert 5 * len(x & y) == 4 * len(x | y)
    below = " ".join(f"v{i}" for i in range(83))  # 79 of 100 shingles
    rows += [(90, below), (91, below + " " + " ".join(f"z{i}" for i in range(21)))]
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows[:-1]} | {91: 91}


def test_no_documents(spark):
    assert probminhash.near_duplicates(frame(spark, [])).count() == 0
    assert probminhash.near_duplicates(frame(spark, [(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("low, high", [(0.9, 0.99), (0.3, 0.7)])
def test_signatures_agree_as_often_as_similar(low, high):
    random.seed(8)
    gaps = []
    for _ in range(30):
        a = [f"w{random.randrange(30)}" for _ in range(150)] * random.randrange(1, 3)
        b = [x if random.random() < (0.99 if low > 0.5 else 0.9) else "zz" for x in a]
        data, starts = common.utf8(pa.array([" ".join(a), " ".join(b)]))
        owner, value, weight = probminhash.weighted_shingles(data, starts)
        rows = probminhash.signatures(owner, value, weight, 2, 1000)
        cut = np.searchsorted(owner, 1)
        exact = probminhash.similarity(value[:cut], weight[:cut], value[cut:], weight[cut:])
        assert abs(exact - jaccard(shingles(" ".join(a)), shingles(" ".join(b)))) < 1e-9
        gaps.append((rows[0] == rows[1]).mean() - exact)
    assert abs(np.mean(gaps)) < 0.01


def test_signatures_of_few_shingles():
    data, starts = common.utf8(pa.array(["a", "a b c d e f", "", "a"]))
    owner, value, weight = probminhash.weighted_shingles(data, starts)
    rows = probminhash.signatures(owner, value, weight, 4, 240)
    assert (rows[0] == rows[3]).all() and len(set(rows[0])) == 1 and len(set(rows[1])) == 2 and not rows[2].any()
