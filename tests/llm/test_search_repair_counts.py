"""Lexical search, conversation repair and token counts against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from incident_mart.llm import common, lexical, registry, repair, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")


# Token counts


@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(WORDS)


def library_count(coder, text):
    return len(coder.encode(text or "", add_special_tokens=False).ids)


ODD = ["it's", "a", "ΑΣ", "Σ", "é", "é", "́", " ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", "ﬁ", "한", "한", "İ", "12", "!?", "H", "\u0331", "I", "\u0307", "Don't", "<", "\u0338", "à", "×", "÷", "É", "ß", "K", "\"", "LL", "<|ENDOFTEXT|>", "re", ".", "7",
       "<|endoftext|>", "<|startoftext|>", "<|end", "'S", "'re", "😀", "漢字", "_", "\x00", "-"]


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=14).map("".join))
def test_chunks_add_up_to_the_library(coder, text):
    with open(WORDS, encoding="utf-8") as f:
        file = f.read()
    data, starts = common.utf8(pa.array([text, "", None, text + "É"]))
    for chunks, said in zip(token_counts.chunks_of(data, starts, token_counts.special_bytes(file)), (text, "", "", text + "É")):
        total = 0
        for chunk in chunks:
            found, own = token_counts.cut(chunk.decode(), coder, token_counts.specials(file))
            total += own + sum(n * len(coder.model.tokenize(p)) for p, n in found.items())
        assert total == library_count(coder, said)


def test_other_vocabularies_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="vocabulary"):
        token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "Hello, it's a <|endoftext|> test<|startoftext|>ing!",
    "",
    None,
    "   \n\t ",
    "word " * 5000,
    "x" * 20000,
    "ΑΣ ΑΣ. Été déjà 漢字　漢字 한국어",
    "a\x1cb\x85c d\x0be",
    "same text",
    "same text",
]


def texts_frame(spark, texts):
    listed = [(None if i == 3 else i // 2, t, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(listed, "doc_id long, text string, chunk string, row int")


@pytest.mark.parametrize("frequent", [1 << 20, 3])
def test_token_counts(spark, coder, monkeypatch, frequent):
    # With few frequent chunks the others take the way of the join.
    monkeypatch.setattr(token_counts, "FREQUENT", frequent)
    got = token_counts.count_tokens(texts_frame(spark, TEXTS).repartition(3), WORDS, limit=100)
    want = []
    for i, t in enumerate(TEXTS):
        n = library_count(coder, t)
        want.append((None if i == 3 else i // 2, len((t or "").encode()), n, n > 100))
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_token_counts_of_nothing(spark):
    assert token_counts.count_tokens(texts_frame(spark, TEXTS).limit(0), WORDS).count() == 0
    blank = token_counts.count_tokens(texts_frame(spark, [None, "", " "]), WORDS)
    assert [r.n_tokens for r in blank.collect()] == [0, 0, 0]


def test_chunks_are_passed_on_in_parts(spark, monkeypatch):
    words = ["".join(chr(97 + int(c)) for c in str(i % 700)) for i in range(5000)]
    text = " ".join(words)
    monkeypatch.setattr(token_counts, "HELD_CHUNKS", 100)
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string").coalesce(1)
    totals = token_counts.chunk_totals(docs, WORDS)
    assert {bytes(r.chunk): r.n for r in totals.collect()} == {k.encode(): 4 * v for k, v in Counter(words).items()}


def test_frequent_chunks_have_a_bound():
    # n / total >= length / (FREQUENT * SHORT) for each, and the n add up to total.
    rng = random.Random(1)
    chunks = [(rng.randint(1, 500), rng.randint(1, 10**6)) for _ in range(5000)]
    total = sum(n for _, n in chunks)
    limit = 50 * token_counts.SHORT
    taken = [(size, n) for size, n in chunks if n * limit >= total * max(token_counts.SHORT, size)]
    assert len(taken) <= 50 and sum(size for size, _ in taken) <= limit


# Lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain_search(docs, items, k=10):
    bags = [(doc_id, Counter(plain_terms(t))) for doc_id, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            n, score = sum(bag.values()), 0
            for t in plain_terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        ranked = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item_id, i + 1, doc_id, -score) for i, (score, _, doc_id) in enumerate(ranked)]
    return sorted(out, key=repr)


def test_terms_of_bytes():
    for text in ("Straße ÉÀ-B9_z@\x00q\x7fx", "日本 abc", "'[]{}", ""):
        assert [t.decode() for t in lexical.terms(text.encode())] == plain_terms(text)


def corpus(rng, n):
    vocabulary = [f"t{i}" for i in range(40)] + ["Ü", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "... !"), (None, docs[3][1]), docs[5], docs[5], (n + 3, "t30 " * 30000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(25)]
    # More than 64 terms, repeats, unknown terms, nothing at all.
    items += [(30, " ".join(f"t{i}" for i in range(40)) + " " + " ".join(f"u{i}" for i in range(80))), (31, "T0 t0 t0!"), (32, "zzz"), (33, None)]
    return docs, items


@pytest.mark.parametrize("block,parts", [(8192, 1), (7, 5)])
def test_ranked_search(spark, monkeypatch, block, parts):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    docs, items = corpus(random.Random(4), 200)
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").repartition(parts)
    queries = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = lexical.ranked_search(frame, queries)
    assert rows(got, "item_id", "rank", "doc_id", "score") == plain_search(docs, items)
    if parts == 5:
        # Queries in several rounds give the same.
        assert rows(lexical.ranked_search(frame, queries, query_bytes=700)) == rows(got)


def test_masks_of_many_terms():
    rng = np.random.default_rng(2)
    docs = [[int(t) for t in np.flatnonzero(rng.random(150) < 0.3)] for _ in range(50)]
    arrays = [pa.array([200] * 50), pa.array(docs, pa.list_(pa.int32())), pa.array([[1] * len(d) for d in docs], pa.list_(pa.int64()))]
    block = lexical.Postings(pa.RecordBatch.from_arrays(arrays, names=["n", "terms", "tfs"]), 50, 10000)
    distinct, group = lexical.masks(block, np.arange(150))
    for i, d in enumerate(docs):
        assert [b for b in range(150) if int(distinct[group[i], b // 64]) >> (b % 64) & 1] == d
    # Documents that no bound admits are not scored: the best of one term is found among all.
    best, scores = lexical.best_documents(block, np.arange(150), np.ones(150, np.int64), np.arange(50), 3)
    assert [len(docs[b]) for b in best] == sorted(map(len, docs), reverse=True)[:3] and list(scores) == sorted(scores)[::-1]


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked_search(docs, items).collect() == []
    assert lexical.ranked_search(docs.limit(0), items).collect() == []
    assert lexical.ranked_search(docs, items.limit(0)).collect() == []


# Conversation repair


def plain_damage(listed):
    out = defaultdict(list)
    for conv_id, turn, role, text in listed:
        out[conv_id]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            out[conv_id] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for turns in out.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}".encode(), r[1].encode()))
    return out


def plain_rows(turns):
    """(role, text, must go, truncated) of each row, and the counts of faults."""
    seen, out, counts = set(), [], [0, 0, 0]
    for _, role, text in turns:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        out.append((role, text, fault in (0, 1), fault == 2))
    return out, counts


def plain_repair(turns):
    """All edits of all rows, the best prefix of each (roles said so far, as the grammar sees them)."""

    def extend(states, role):
        return states + role if re.fullmatch("(s|s?(ua)*u?)?", states + role) else None

    def short(said):
        # Pairs beyond the first do not matter to what may follow.
        return re.sub("(ua)(ua)+", r"\1", said)

    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for said, (cost, audit, lines) in list(best.items()):
                for role, name in (("u", "user"), ("a", "assistant")):
                    after = extend(said, role)
                    if after is not None:
                        new = (cost + 5, audit + "I", (*lines, f"{name}:"))
                        best[short(after)] = min(best.get(short(after), new), new, key=lambda x: x[:2])
        return best

    for role, text, gone, cut in turns:
        after = {}
        for said, (cost, audit, lines) in inserted(best).items():
            moves = [(said, cost + 2, audit + "D", lines)]
            if not gone:
                more = 5 if cut else 0
                moves += [(extend(said, role[:1]) if role else None, cost + more, audit + "K", (*lines, f"{role}:{text}"))]
                moves += [(extend(said, r), cost + 1 + more, audit + "R", (*lines, f"{n}:{text}")) for r, n in (("u", "user"), ("a", "assistant"))]
            for to, *new in moves:
                if to is not None:
                    after[short(to)] = min(after.get(short(to), tuple(new)), tuple(new), key=lambda x: x[:2])
        best = after
    ended = [x for said, x in inserted(best).items() if re.fullmatch("(s?(ua)+)?", said)]
    cost, audit, lines = min(ended, key=lambda x: x[:2])
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain_report(listed):
    out = []
    for conv_id, turns in plain_damage(listed).items():
        known, counts = plain_rows(turns)
        places = [t for t, _, _ in turns if t is not None]
        gaps = max(places) - min(places) + 1 - len(set(places)) if places else 0
        pairs = zip(known, known[1:])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        out.append((conv_id, gaps, *counts, illegal, *plain_repair(known)))
    return sorted(out, key=repr)


def exhaustive(turns):
    """Every choice of every row, and up to two insertions at every place."""
    gaps = ["", "u", "a", "ua", "au"]
    found = []
    for inserts in itertools.product(gaps, repeat=len(turns) + 1):
        for edits in itertools.product(["K", "Ru", "Ra", "D"], repeat=len(turns)):
            cost, audit, said = 0, "", ""
            for i, (role, _, gone, cut) in enumerate(turns):
                cost += 5 * len(inserts[i]) + {"K": 0, "R": 1, "D": 2}[edits[i][0]] + (5 if cut and edits[i] != "D" else 0)
                audit += "I" * len(inserts[i]) + edits[i][0]
                said += inserts[i] + {"K": role[:1] or "?", "D": ""}.get(edits[i], edits[i][1:])
                cost += 1000 if gone and edits[i] != "D" else 0
            cost += 5 * len(inserts[-1])
            if re.fullmatch("(s?(ua)+)?", said + inserts[-1]):
                found.append((cost, audit + "I" * len(inserts[-1])))
    return min(found)


def parse(turns, cuts=()):
    """Cost and audit as the operator finds them, with pieces that begin at ``cuts``."""
    whole, start = repair.Parse(), 0
    if not cuts:
        for role, _, gone, cut in turns:
            whole.row(role[:1], gone, cut)
        return whole.result()
    for number, end in enumerate([*cuts, len(turns)]):
        parts = [repair.Parse(t) for t in (repair.TOPS if number else (0,))]
        for role, _, gone, cut in turns[start:end]:
            for part in parts:
                part.row(role[:1], gone, cut)
        whole.piece([m for t, part in enumerate(parts) for m in part.moves(t)])
        start = end
    return whole.result()


ROW = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.just("x"), st.booleans(), st.booleans())


@settings(max_examples=12, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_repairs_are_the_cheapest_of_all(turns):
    assert parse(turns) == exhaustive(turns)


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, max_size=25), st.lists(st.integers(0, 25), max_size=4))
def test_repairs_in_pieces(turns, cuts):
    want = plain_repair(turns)[:2]
    assert parse(turns) == want
    assert parse(turns, sorted(min(c, len(turns)) for c in cuts) or (0,)) == want


def test_notes_between_segments(monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 3)
    rng = random.Random(3)
    for _ in range(50):
        turns = [(rng.choice(["user", "assistant", "system"]), "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(40)]
        assert parse(turns) == plain_repair(turns)[:2] == parse(turns, (5, 5, 23))


def conversations(rng):
    out = []
    for conv_id in [*range(40), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "", " \n", None, "Why?  ", "日本!", "a:b\nc."])
            out.append((conv_id, rng.choice([turn, turn, turn + 2, None]), role, text))
    # One conversation holds a third of all rows, many of them copies.
    out += [(7, i % 60, ["user", "assistant"][i % 2], f"Word {i % 11}.") for i in range(len(out) // 2)]
    return out


@pytest.mark.parametrize("parts", [1, 8])
def test_repair_report(spark, conf, parts):
    listed = conversations(random.Random(6))
    conf("spark.sql.shuffle.partitions", str(parts))
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    frame = spark.createDataFrame([(*r, 5, "z") for r in listed], "conv_id long, turn long, role string, text string, copies int, said string")
    got = repair.repair_report(frame)
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert rows(got, *names) == plain_report(listed)


def test_repair_equals_sql(spark):
    listed = [(i, *r[1:]) for i, r in enumerate(conversations(random.Random(8))) if r[0] != 7]
    listed = [(i // 5, i % 5, role, text) for i, _, role, text in listed]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", listed)
    want = con.execute(registry.oracle_sql()["op12_glr_repair"]).fetchall()
    assert sorted(want, key=repr) == plain_report(listed)


def test_repair_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair_report(spark.createDataFrame([], schema)).collect() == []
    dropped = next(i for i in itertools.count() if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair_report(spark.createDataFrame([(dropped, 0, "user", "Hi.")], schema)).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversation_with_long_texts(spark):
    text = "word " * 100_000 + "."
    listed = [(1, i, ["user", "assistant"][i % 2], f"{i} {text}") for i in range(20)]
    got = repair.repair_report(spark.createDataFrame(listed, "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in got.collect()] == plain_report(listed)
