import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from brute import base_spans, pii_row
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from incident_mart.llm import byte_bpe, chat, common, pii, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return byte_bpe.Vocabulary(f.read())


PIECES = ["a", "s", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", " ", "　", "1", "é", "漢", "😀", ".", "!", "ll", "'t", "\r\n", "²", "́"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=20))
def test_ids_equal_the_library(coder, vocabulary, texts):
    ids, bounds, ends = byte_bpe.encode_batch(pa.array(texts), vocabulary)
    for i, text in enumerate(texts):
        got = ids[bounds[i] : bounds[i + 1]].tolist()
        assert got == coder.encode_ordinary(text)
        stops = ends[bounds[i] : bounds[i + 1]].tolist()
        assert not got or stops[-1] == len(text.encode())


def test_long_and_odd_texts(coder, vocabulary):
    texts = ["a" * 5000, " " * 3000, "ab" * 4000 + "c", "", None, "\n" * 100 + "x", "é" * 3000, "'s" * 500]
    ids, bounds, _ = byte_bpe.encode_batch(pa.array(texts), vocabulary)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == coder.encode_ordinary(text or "")
    data, starts = byte_bpe.decode_batch(ids.astype("int64"), bounds, vocabulary)
    for i, text in enumerate(texts):
        assert data[starts[i] : starts[i + 1]].tobytes() == (text or "").encode()


def thue_morse(letters, size):
    return "".join(letters[bin(i).count("1") % 2] for i in range(size))


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
def test_pieces_that_share_a_hash(coder, vocabulary, size):
    # Any polynomial modulo a power of two gives such words the same value.
    texts = [thue_morse("ab", size), thue_morse("ba", size), thue_morse("ab", size) + " x", thue_morse("ba", size)]
    ids, bounds, _ = byte_bpe.encode_batch(pa.array(texts), vocabulary)
    data, starts = byte_bpe.decode_batch(ids.astype("int64"), bounds, vocabulary)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == coder.encode_ordinary(text)
        assert data[starts[i] : starts[i + 1]].tobytes() == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), min_size=1, max_size=15))
def test_ids_with_a_poor_hash(coder, vocabulary, texts):
    class Poor(common.SliceHash):
        def of(self, begin, end):
            return super().of(begin, end) & np.uint64(3)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(byte_bpe, "SliceHash", Poor)
        ids, bounds, _ = byte_bpe.encode_batch(pa.array(texts), vocabulary)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == coder.encode_ordinary(text)


def test_texts_over_many_blocks(coder, vocabulary, monkeypatch):
    monkeypatch.setattr(byte_bpe, "DECODED_IDS", 7)
    monkeypatch.setattr(byte_bpe, "WIDTH", 16)
    texts = [f"it's word {i}  \n's don't " * (i % 7) for i in range(60)]
    parts = [byte_bpe.encode_batch(pa.array(texts), vocabulary)]
    monkeypatch.setattr(byte_bpe, "blocks", lambda s: common.blocks(s, 50))
    parts.append(byte_bpe.encode_batch(pa.array(texts), vocabulary))
    assert all((a == b).all() for a, b in zip(*parts))
    assert parts[0][0].tolist() == [i for t in texts for i in coder.encode_ordinary(t)]


def test_encode_and_decode_frames(spark, coder):
    rows = [(1, "Hello's world", "x"), (2, None, "y"), (3, "", "z"), (1, "Hello's world", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).collect()
    for r in out:
        assert r.ids == coder.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    digests = byte_bpe.round_trip_digests(docs, PATH).collect()
    assert sorted(d.n_tokens for d in digests) == sorted(len(r.ids) for r in out)
    assert byte_bpe.round_trip_digests(docs.limit(0), PATH).count() == 0
    empty = [d for d in digests if d.doc_id == 2][0]
    assert empty.decoded_sha256 == hashlib.sha256(b"").hexdigest()


PII = [
    "mail bob.x@mail.example.com or a@b.c_d@e.f, x@y, @z.com",
    "ip 1.2.3.4 and 256.1.1.1 and 01.002.3.4.5.6.7.8 or 1.2.3",
    "card 4111 1111 1111 1111 4111-1111-1111-1112 12345 " + "9" * 30,
    "call +1 (202) 555-0143 or +12 or +1" + "-" * 40 + "2 ++44 20 7946 0958.",
    "é😀 +49 30 1234567 😀 a@b.de 5500000000000004",
    "@" * 50 + "." * 50 + "1." * 50,
    "a" * 20000 + "1" * 20000,
    "",
    None,
]


def test_base_spans_equal_a_plain_scan(spark):
    rows = [(i, t, "x") for i, t in enumerate(PII)] + [(0, PII[0], "x"), (None, "a@b.cd", "x")]
    extra = "doc_id long, text string, candidates string"
    got = pii.span_report(spark.createDataFrame(rows, extra)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "a@b.cd" if r.doc_id is None else PII[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == pii_row(text), text
        listed = {f"{k}:{a}:{b}" for k, a, b in base_spans(text)}
        assert listed <= set(filter(None, r.spans.split(",")))


def test_spans_are_added_where_labelers_agree(spark):
    rows = [(i, f"Please call me on (212) 555-{1000 + i} today") for i in range(300)]
    rows += [(1000 + i, f"order number 212 555 {1000 + i}= done") for i in range(300)]
    rows += [(2000 + i, f"phone +1 212 555 {1000 + i}") for i in range(300)]
    got = {r.doc_id: r for r in pii.span_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5].spans == "phone:18:32" and got[5].n_phone == 0
    assert got[1005].spans == "" and got[2005].n_phone == 1


def test_a_text_of_many_matches(spark):
    """Offsets and masks of thousands of spans, over many blocks and chunks, in linear time."""
    parts = [("host 10.2.%d.%d é" % (i % 256, i % 199)) if i % 3 else "😀 mail a%d@b.co, " % i for i in range(20000)]
    text = " ".join(parts) + "x" * 1500 + "+1 212 555 0143"
    docs = spark.createDataFrame([(1, text, 0), (2, "a@b.cd", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in pii.span_report(docs).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone, got[1].base_sha256) == pii_row(text)
    clean, at = "", 0
    for kind, a, b in sorted(base_spans(text), key=lambda s: s[1]):
        clean, at = clean + text[at:a] + f"[{kind.upper()}]", b
    clean = {r.doc_id: r.text for r in pii.masked(docs).collect()} | {0: clean + text[at:]}
    assert clean[1] == clean[0] and clean[2] == "[EMAIL]"


def test_running_values_and_cuts(spark):
    def cut(a, b):
        return pii._let(pii._chunks(F.col("t")), lambda c: pii._cut(c, F.lit(a), F.lit(b))).alias(f"cut{a}_{b}")

    rows = [(list(range(n)), "aé😀b" * n) for n in (0, 1, 127, 128, 129, 1200)]
    out = spark.createDataFrame(rows, "xs array<int>, t string").select(
        "xs",
        "t",
        pii._before(F.col("xs"), lambda a, b: a + b).alias("sums"),
        pii._before(F.col("xs"), F.greatest).alias("most"),
        *[cut(a, b) for a, b in CUTS],
    )
    for r in out.collect():
        assert list(r.sums) == [sum(r.xs[:i]) for i in range(len(r.xs))]
        assert list(r.most) == [max(r.xs[:i], default=0) for i in range(len(r.xs))]
        for a, b in CUTS:
            assert r[f"cut{a}_{b}"] == r.t[a:b], (a, b, len(r.t))


CUTS = [(0, 0), (0, 3), (500, 512), (511, 513), (512, 512), (512, 600), (100, 2000), (1024, 1025), (4799, 4801)]


def test_spans_that_overlap_the_base_are_not_added(spark):
    def all_pairs(candidates, accepted):
        base = [c[:3] for c in candidates if c[3]]
        more = [c[:3] for c in candidates if not c[3] and c[0] * 81 + c[4] in accepted]
        return sorted(base + [c for c in more if not any(b[1] < c[2] and c[1] < b[2] for b in base)])

    random = np.random.default_rng(4)
    rows = []
    for i in range(60):
        spans = []
        for a in random.integers(0, 200, random.integers(0, 40)).tolist():
            kind, length, base, votes = (int(random.integers(n)) for n in (4, 11, 2, 3))
            spans.append((kind, a, a + length + 1, bool(base), votes))
        rows.append((i, spans))
    docs = spark.createDataFrame(rows, f"doc_id long, candidates {pii._CANDIDATE}")
    accepted = [k * 81 + v for k in range(4) for v in (0, 2)]
    for r in docs.withColumn("all", pii.decided(accepted)).collect():
        assert [(s.kind, s.start, s.end) for s in r["all"]] == all_pairs([tuple(c) for c in r.candidates], accepted)


def test_masking(spark):
    rows = [
        (1, "see a@b.cd, 1.2.3.4 é x", "row", 23),
        (2, "nothing here", "row", 12),
        (3, None, "row", None),
        (4, "+1 202 555 0143", "row", 15),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert got[1].text == "see [EMAIL], [IP] é x" and got[1].n_chars == 21 and got[1].spans == "row"
    assert got[2].text == "nothing here" and got[3].text is None and got[4].text == "[PHONE]"
    assert pii.masked(docs).columns == docs.columns
    assert pii.masked(docs.limit(0)).count() == 0


CHAT = "conv_id long, turn long, role string, text string, message string"
TEXTS = ["<|turn|>user\nhi<|end|>\n", "<\\|<|<\\\\|end|>", "", None, "a\nb\n", "<", "\\", "|end|>", "é😀" * 50]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "sys\ntem%0A<|", None]
    rows = [(c, t, roles[(c + t) % 4], TEXTS[(c * 3 + t) % len(TEXTS)], "x") for c in range(6) for t in range(7)]
    rows += [(None, 0, "user", "no id", "x"), (1, None, "assistant", "no turn", "x"), (2, 3, "assistant", "tie", "x")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, CHAT))
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.parsed(formatted).collect()}
    want = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: sorted(v) for c, v in back.items()} == {c: sorted(v) for c, v in want.items()}
    assert back[0] == want[0] and back[1][0] == ("assistant", "no turn")
    for r in formatted.collect():
        said = [r.formatted[s.start : s.end].replace("<\\", "<", 0) for s in r.loss_spans]
        assert len(said) == sum(role == "assistant" for role, _ in back[r.conv_id])
        assert r.formatted.count("<|turn|>") == len(back[r.conv_id])


def test_events_fold(spark):
    log = [
        (1, 1, 0, 0, "open", "user", None),
        (1, 1, 0, 1, "delta", None, "he"),
        (1, 1, 0, 2, "delta", None, "llo"),
        (1, 2, 1, 0, "open", "assistant", "seed "),
        (1, 2, 1, 1, "delta", None, "bad"),
        (1, 2, 1, 2, "regenerate", None, None),
        (1, 2, 1, 3, "delta", None, "good"),
        (1, 2, 1, 4, "delta", None, None),
        (1, 3, 2, 0, "open", "user", None),
        (1, 3, 2, 1, "delta", None, "x"),
        (1, 3, 2, 2, "edit", None, "edited"),
        (2, 4, 0, 7, "delta", None, "late b"),
        (2, 4, 0, 3, "delta", None, "early a "),
    ]
    got = chat.folded(spark.createDataFrame(log, chat.LOG)).orderBy("conv_id", "turn").collect()
    assert [r.text for r in got] == ["hello", "good", "edited", "early a late b"]
    assert [r.role for r in got] == ["user", "assistant", "user", None]


def test_what_is_rendered_follows_from_the_events(spark):
    rows = [(1, 0, "user", "plain", "x"), (1, 1, "assistant", "a <|end|>\n<|turn|>user\nb <\\|", "x")]
    log = chat.turn_log(spark.createDataFrame(rows, CHAT)).localCheckpoint()
    kinds = [(r.turn, r.kind) for r in log.orderBy("turn", "seq").collect()]
    assert kinds == [(0, "open"), (0, "delta"), (1, "open"), (1, "delta"), (1, "edit")]

    def read_back(events):
        (found,) = chat.parsed(chat.rendered(chat.folded(events))).collect()
        return [(t.role, t.text) for t in found.turns]

    assert read_back(log) == [r[2:4] for r in rows]
    # Without the edit the text would end its own turn and begin another one.
    assert len(read_back(log.filter("kind <> 'edit'"))) == 3
    assert read_back(log.filter("kind <> 'delta'"))[0] == ("user", "")


def test_long_texts_are_streamed_and_regenerated(spark):
    n = chat.DELTA_CHARS
    clean = "é😀\r\n" * n
    unsafe = "x" * (n - 1) + "<|end|>\n<|turn|>user\n" + "<\\|" * n
    rows = [(1, 0, "user", clean, "x"), (1, 1, "assistant", unsafe, "x"), (2, 0, "assistant", "y" * n, "x")]
    log = chat.turn_log(spark.createDataFrame(rows, CHAT)).localCheckpoint()
    found = {}
    for r in log.orderBy("conv_id", "turn", "seq").collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.seq, r.kind, r.text))
    assert [kind for _, kind, _ in found[2, 0]] == ["open", "delta"]
    assert [kind for _, kind, _ in found[1, 0]] == ["open", *["delta"] * 4]
    kinds = [kind for _, kind, _ in found[1, 1]]
    assert kinds == ["open", *["delta"] * 5, "regenerate", *["delta"] * 6]
    for events in found.values():
        assert [seq for seq, _, _ in events] == list(range(len(events)))
        assert all(len(text) <= n for _, kind, text in events if kind == "delta")

    def read_back(events):
        return [[(t.role, t.text) for t in r.turns] for r in chat.parsed(chat.rendered(chat.folded(events))).orderBy("conv_id").collect()]

    want = [[("user", clean), ("assistant", unsafe)], [("assistant", "y" * n)]]
    assert read_back(log) == want
    # Each kind decides: what was said first, and every delta in its order, would change the texts.
    without = read_back(log.filter("kind <> 'regenerate'"))
    assert without != want and without[1] == want[1]
    assert read_back(log.filter("not (kind = 'delta' and seq = 2)"))[0][0] == ("user", clean[:n] + clean[2 * n :])


def test_no_conversations(spark):
    assert chat.format_conversations(spark.createDataFrame([], CHAT)).count() == 0


def toxic_corpus(n=600):
    rows, labels = [], []
    for i in range(n):
        clean = [f"word{i % 97} thing{(i * k) % 89} calm." for k in range(1, 6)]
        bad = i % 6 == 0
        if bad:
            clean.insert(i % 4, f"you rotten{'abcdef'[i % 6]}x fool.")
        rows.append((i, " ".join(clean), "x", "y", 0))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_from_document_labels(spark):
    rows, labels = toxic_corpus()
    rows += [(9001, None, "x", "y", 0), (9002, "", "x", "y", 0), (9003, "...", "x", "y", 0), (None, "calm.", "x", "y", 0)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], DOCS + ", score string")
    given_labels = spark.createDataFrame([*labels, (None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs, given_labels).collect()}
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [i for i in truth if got[i].held_out]
    assert len(held) > 80 and sum(got[i].predicted == truth[i] for i in held) >= 0.99 * len(held)
    texts = {r[0]: r[1] for r in rows}
    for i in held:
        said = [texts[i][s.start : s.end] for s in got[i].offending]
        assert all("rotten" in s for s in said) and bool(said) == bool(truth[i])
    assert got[9001].score == got[9002].score == got[9003].score == 0 and got[None].predicted == 0
    kept = toxicity.without_toxic(docs, given_labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())


def predicted(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS)
    given_labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    return {r.doc_id: r for r in toxicity.toxicity_report(docs, given_labels).collect()}


def test_toxicity_of_mostly_toxic_labels(spark):
    rows, labels = toxic_corpus()
    bad = [(i, r[1]) for i, r in enumerate(rows) if i % 6 == 0]
    clean = [(i, r[1]) for i, r in enumerate(rows) if i % 6 == 1][:25]
    some = [(i, t, "x", "y", 0) for i, t in bad + clean]
    got = predicted(spark, some, [(i, int(i % 6 == 0)) for i, _ in bad + clean])
    right = [got[i].predicted == int(i % 6 == 0) for i, _ in bad + clean]
    assert sum(right) >= 0.98 * len(right)


def test_toxicity_of_three_toxic_rows(spark):
    rows, labels = toxic_corpus()
    plain = [r for r in rows if r[0] % 6]
    ids = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5]
    mean = [(i, f"word{k} thing{k} calm. you rotten fool. thing{k + 9} calm.", "x", "y", 0) for k, i in enumerate(ids[:20])]
    known = [(i, y) for i, y in labels if i % 6] + [(r[0], 1) for r in mean[:3]]
    got = predicted(spark, plain + mean, known)
    assert all(got[r[0]].predicted == 1 for r in mean)
    assert sum(got[r[0]].predicted for r in plain) <= 0.01 * len(plain)


def test_toxicity_does_not_grow_with_length(spark):
    rows, labels = toxic_corpus()
    long = " ".join(f"word{i % 97} thing{i % 89} calm." for i in range(60_000))
    got = predicted(spark, [*rows, (5000, long, "x", "y", 0), (5001, long + " you rottenax fool.", "x", "y", 0)], labels)
    assert got[5000].predicted == 0 and got[5001].predicted == 1


def test_toxicity_learns_from_one_text_of_each_document(spark, monkeypatch):
    rows, labels = toxic_corpus()
    held = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    clean = next(i for i, y in labels if not y and i not in held)
    more = [(clean, f"you rotten{'abcdef'[k % 6]}x fool. more{k}.", "x", "y", 0) for k in range(3000)]
    absent = [(i, k % 2) for k, i in enumerate(range(10_000, 30_000))]
    learn = toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda docs, known: learn(docs, known, 450))
    got = predicted(spark, [r for r in rows if r[0] != clean] + more, [*labels, *absent])
    assert all(got[i].predicted == y for i, y in labels if i != clean)


def test_toxicity_learns_clean_words():
    seen = np.array([400, 100, 300, 3, 200])
    seen_toxic = np.array([300, 100, 200, 3, 0])
    assert toxicity.telling(seen, seen_toxic, 600, 400).tolist() == [0, 1, 4]
    assert toxicity.telling(np.array([3, 30]), np.array([3, 1]), 480, 3).tolist() == [0]
    assert not len(toxicity.telling(np.array([5, 9]), np.array([5, 9]), 9, 9))


def test_toxicity_without_labels(spark):
    rows, _ = toxic_corpus(20)
    docs = spark.createDataFrame(rows + [(99, "some words here. " * 3000, "x", "y", 0)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity_report(docs, none).collect()} == {0}
    assert toxicity.toxicity_report(docs.limit(0), none).count() == 0
