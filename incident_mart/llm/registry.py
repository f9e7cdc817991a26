"""The registered queries of this subpackage; each takes the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe,
    chat,
    int8_tiles,
    lexical,
    mixing,
    pii,
    pivot_topk,
    probminhash,
    repair,
    token_counts,
    toxicity,
    virtual_slots,
    warc,
)
from .common import table

#: The vocabulary of the registered queries.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return virtual_slots.shard_documents(table(spark, sf_dir, "documents"))


def op4_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return int8_tiles.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the rank that the merge gives; without places in files and key ranges, which depend on how tasks were dealt."""
    history = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return history.drop("run", "offset", "key_range", "place")


def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op9_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    added = spark.createDataFrame(more, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(added)))


def op10_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(table(spark, sf_dir, "conversations"))


def op13_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


OP9_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
    SELECT *,
        '<|turn|>' || replace(replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), '%', '%25'), chr(10), '%0A')
        || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|end|>' || chr(10) AS chunk
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, chunk)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, chunk) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(chunk)) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


OP4_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached(a, b) AS (
    SELECT a, b FROM links
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(r.low, e.vec_id)) AS component_id,
    e.vec_id = least(e.vec_id, coalesce(r.low, e.vec_id)) AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS low FROM reached GROUP BY a) r ON r.a = e.vec_id
"""

OP5_SQL = """
WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.r, q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(x.v AS DOUBLE[])) AS BIGINT) AS score
    FROM usable q JOIN usable x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


OP6_SQL = r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
        regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
    FROM pages
), known AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper, lower(regexp_extract(bare, '^[^/?#]*')) AS host FROM p
)
SELECT page_id, strlen(html) AS payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
        (CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31
    ) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> keeper THEN keeper END AS refers_to,
    array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || substr(bare, length(host) + 1) AS url_key,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured_at,
    row_number() OVER (ORDER BY url_key, captured_at, page_id) AS rank
FROM known
"""

OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), items AS (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), sizes AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), found AS (
    SELECT doc, doc_id, n, term, count(*) AS tf
    FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM items) GROUP BY doc, doc_id, n, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM found, sizes GROUP BY term, n_docs
), scores AS (
    SELECT item, item_id, doc, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM items JOIN found USING (term) JOIN weights USING (term), sizes
    GROUP BY item, item_id, doc, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _edit(state: str, cost: str, letter: str) -> str:
    """A state, twelve digits of cost and the audit, after one more edit; null stays null."""
    return f"printf('%012d', CAST(substr({state}, 1, 12) AS BIGINT) + {cost}) || substr({state}, 13) || '{letter}'"


def _said(symbol: str, *states: str) -> str:
    """The least state after a row taken as ``symbol`` from any of ``states``."""
    worse = "CASE WHEN cut THEN 5 ELSE 0 END"
    each = (
        f"CASE WHEN drop THEN NULL WHEN initial = '{symbol}' THEN {_edit(s, worse, 'K')} ELSE {_edit(s, '1 + ' + worse, 'R')} END"
        for s in states
    )
    return ", ".join(each)


def op12_sql() -> str:
    """Rows by turn, a recursion over them with one state per stack top, and the repaired lines.

    The tops: nothing yet (o), a system turn (s), its user turn (u), whole pairs (p), and
    the user turn after those (q); an ``x`` before the letter is the state with insertions.
    """
    step = {
        "xu": f"least(u, {_edit('o', '5', 'I')}, {_edit('s', '5', 'I')})",
        "xp": f"least(p, {_edit('xu', '5', 'I')}, {_edit('q', '5', 'I')})",
        "xq": f"least(q, {_edit('xp', '5', 'I')})",
    }
    kept_system = f"CASE WHEN NOT drop AND initial = 's' THEN {_edit('o', 'CASE WHEN cut THEN 5 ELSE 0 END', 'K')} END"
    after = {
        "o": _edit("o", "2", "D"),
        "s": f"least({_edit('s', '2', 'D')}, {kept_system})",
        "u": f"least({_edit('xu', '2', 'D')}, {_said('u', 'o', 's')})",
        "p": f"least({_edit('xp', '2', 'D')}, {_said('a', 'xu', 'xq')})",
        "q": f"least({_edit('xq', '2', 'D')}, {_said('u', 'xp')})",
    }
    moved = ", ".join(f"{value} AS {name}" for name, value in after.items())

    def inserted(rows: str) -> str:
        inner = f"SELECT *, {step['xu']} AS xu FROM {rows}"
        return f"SELECT *, {step['xq']} AS xq FROM (SELECT *, {step['xp']} AS xp FROM ({inner}))"

    next_row = """(
        SELECT b.conv_id, k.n, o, s, u, p, q, k.initial, k.drop, k.cut
        FROM parsed b JOIN known k ON b.conv_id IS NOT DISTINCT FROM k.conv_id AND k.n = b.n + 1)"""
    return rf"""
WITH RECURSIVE bits AS (
    SELECT list(c ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
        FROM (SELECT unnest(range(256)) AS i))
), marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, x: xor(c >> 8, crc[CAST(xor(c, x) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT))) % 20 AS kind
    FROM conversations, bits
), turns AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM marked WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || ':' || text, role, copy) AS n FROM turns
), told AS (
    SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again FROM placed
), known AS (
    SELECT *, solid = '' AS blank, solid = '' OR again AS drop, right(solid, 1) NOT IN ('.', '!', '?') AS cut,
        coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal FROM told
), parsed AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000000000' AS o, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u,
        CAST(NULL AS VARCHAR) AS p, CAST(NULL AS VARCHAR) AS q
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, n, {moved} FROM ({inserted(next_row)})
), best AS (
    SELECT conv_id, n, least(o, xp) AS state FROM ({inserted('parsed')})
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1
), edits AS (
    SELECT conv_id, unnest(range(1, length(state) - 11)) AS i, substr(state, 13) AS audit FROM best
), acts AS (
    SELECT conv_id, i, audit[i] AS edit, sum(CASE WHEN audit[i] = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS n FROM edits
), kept AS (
    SELECT a.conv_id, a.i, a.edit, k.role, k.text, k.initial, row_number() OVER (PARTITION BY a.conv_id ORDER BY a.i) AS place
    FROM acts a LEFT JOIN known k ON a.edit <> 'I' AND a.conv_id IS NOT DISTINCT FROM k.conv_id AND a.n = k.n WHERE a.edit <> 'D'
), lines AS (
    SELECT conv_id, i, CASE WHEN edit = 'K' THEN role
        WHEN (place - max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1
        THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
    FROM kept
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT drop AND cut) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM known GROUP BY conv_id
), said AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS whole FROM lines GROUP BY conv_id)
SELECT b.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
    coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(substr(state, 1, 12) AS BIGINT) AS cost,
    substr(state, 13) AS audit, sha256(coalesce(s.whole, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN said s ON b.conv_id IS NOT DISTINCT FROM s.conv_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name, in the order of the operators."""
    every = (
        op1_hypergeometric_mix,
        op2_probminhash,
        op3_virtual_slots,
        op4_int8_tiles,
        op5_pivot_topk,
        op6_warc_index,
        op7_weak_pii,
        op8_byte_bpe,
        op9_chat_events,
        op10_noisy_or_toxicity,
        op11_mask_search,
        op12_glr_repair,
        op13_pretoken_counts,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the whole result."""
    return {
        "op4_int8_tiles": OP4_SQL,
        "op5_pivot_topk": OP5_SQL,
        "op6_warc_index": OP6_SQL,
        "op9_chat_events": OP9_SQL,
        "op11_mask_search": OP11_SQL,
        "op12_glr_repair": op12_sql(),
    }
