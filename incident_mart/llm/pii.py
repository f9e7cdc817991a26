"""Personal data by weak supervision, in DataFrame functions only.

Regular expressions propose candidate spans: strict ones, which are always personal data
(the base), and wider ones. Four labelers vote on each candidate, each for, against or
not at all: the strict pattern, a gazetteer, the words before, and the characters
around. Votes are counted over all documents; expectation-maximisation over the table of
vote patterns (a few hundred rows, whatever the corpus) estimates how reliable each
labeler is and how likely each pattern; a logistic span classifier is then trained on
those probabilities. Its decisions go back to the candidates as a list of patterns.

Offsets come from the text between matches, so they are exact code points. Every array is
made once per text, sums and maxima run over blocks of it and text is cut from short
chunks, so time grows with the text and its matches, not with their product.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: The kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# Runs of one class of characters are matched from their start (or where the last match
# ended) and never given back, so no text takes more than one pass.
_LOCAL = "[A-Za-z0-9._%+-]"
_NAME = "[A-Za-z0-9-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
STRICT = {
    EMAIL: rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
    IP: r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"[0-9](?:[\x20-]?[0-9]){12,}+",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spellings that the strict patterns miss.
WIDE = {
    EMAIL: rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\[at\]|\(at\)|\{{at\}}) ?{_NAME}++(?: ?(?:\[dot\]|\(dot\)|\{{dot\}}|\.) ?{_NAME}++)++",
    PHONE: r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
#: What a text must hold for a pattern to be worth trying.
NEEDS = {(EMAIL, True): "@", (PHONE, True): "+", (EMAIL, False): "at"}

TOP_LEVELS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "us")
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6)"
NOT_PUBLIC_IP = r"^0*(?:0|10|127|2[2-5][0-9])\."
AREA = r"^[^0-9]*(?:1[^0-9]*)?[2-9]"
FOR_WORDS = {
    EMAIL: r"(?i)\b(?:e-?mail|mail|contact|write|reach|address)\b",
    IP: r"(?i)\b(?:ip|host|server|address|from|client|login)\b",
    CARD: r"(?i)\b(?:card|visa|master ?card|credit|debit|payment|pay)\b",
    PHONE: r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|contact|whatsapp)\b",
}
AGAINST_WORDS = r"(?i)\b(?:version|order|isbn|serial|invoice|part|item|model|ref|section|chapter|example|sha|hash)\b"
BEFORE = 32

#: Probability from which the classifier's spans are added to the base.
ACCEPTED = 0.9
#: Believed votes per labeler and class before any are counted, and their accuracy.
PRIOR_VOTES, PRIOR_ACCURACY = 20.0, 0.8
ROUNDS = 40
LABELERS = 4
CONTEXT = 2

_SPAN = "array<struct<start: int, end: int, said: string>>"
_CANDIDATE = "array<struct<kind: int, start: int, end: int, base: boolean, votes: int>>"
_PLACE = "array<struct<start: int, end: int, kind: int>>"
#: Numbers of a block of running values, and code points of a chunk of text.
STEP = 512


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` uses it in a loop."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(numbers: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array the merge (sum or greatest) of 0 and all before it.

    ``numbers`` is a column or bound by ``_let``. Runs in blocks: appending to an array
    copies it, which for one long array would take the square of its length.
    """

    def run(part: Column) -> Column:
        begin = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<int>").alias("each"))
        return F.aggregate(
            part,
            begin,
            lambda done, x: F.struct(
                merge(done["at"], x).cast("int").alias("at"), F.concat(done["each"], F.array(done["at"])).alias("each")
            ),
        )

    def joined(parts: Column) -> Column:
        def placed(begins: Column) -> Column:
            return F.flatten(
                F.transform(parts, lambda p, i: F.transform(p["each"], lambda x: merge(F.get(begins, i), x).cast("int")))
            )

        return _let(run(F.transform(parts, lambda p: p["at"]))["each"], placed)

    starts = F.sequence(F.lit(1), F.size(numbers), F.lit(STEP))

    def block(at: Column) -> Column:
        places = F.sequence(at, F.least(at + (STEP - 1), F.size(numbers)))
        return run(F.transform(places, lambda i: F.get(numbers, i - 1)))

    blocks = F.transform(starts, block)
    return F.when(F.size(numbers) > 0, _let(blocks, joined)).otherwise(F.array().cast("array<int>"))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _chunks(text: Column) -> Column:
    """The text in pieces of STEP code points."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STEP}}}"), F.lit(0))
    return F.when(F.length(text) <= STEP, F.array(text)).otherwise(pieces)


def _cut(chunks: Column, begin: Column, end: Column) -> Column:
    """Code points ``begin`` (from 0) to ``end``, or the last, of a text in chunks; only theirs are read."""
    first = F.floor(begin / F.lit(STEP)).cast("int")
    last = F.greatest(F.floor((end - 1) / F.lit(STEP)).cast("int"), first)
    long = F.array_join(F.transform(F.sequence(first, last), lambda i: F.get(chunks, i)), "")
    part = F.when(first == last, F.coalesce(F.get(chunks, first), F.lit(""))).otherwise(long)
    return F.substring(part, begin - first * STEP + 1, end - begin)


def _located(text: Column, pattern: str, needs: str | None) -> Column:
    """Start, end (code points) and text of every match."""

    def spans(x: Column) -> Column:
        ends = F.transform(x["said"], lambda s, i: F.length(F.get(x["between"], i)) + F.length(s))

        def span(past: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                start = F.get(past, i) + F.length(F.get(x["between"], i))
                return F.struct(start.alias("start"), (start + F.length(s)).alias("end"), s.alias("said"))

            return F.transform(x["said"], one)

        return _let(_let(ends, lambda e: _before(e, _add)), span)

    def found(said: Column) -> Column:
        parts = F.struct(said.alias("said"), F.split(text, pattern, -1).alias("between"))
        return F.when(F.size(said) > 0, _let(parts, spans).cast(_SPAN)).otherwise(F.array().cast(_SPAN))

    every = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)
    return F.when(F.contains(text, F.lit(needs)), every).otherwise(F.array().cast(_SPAN)) if needs else every


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(digit)

    places = F.transform(F.sequence(F.lit(1), F.length(digits)), value)
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: int, said: Column) -> Column:
    """Whether a match of the strict pattern is in the base."""
    if kind == IP:
        return F.rlike(said, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    digits = _digits(said)
    if kind == CARD:
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == PHONE:
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _gazetteer(kind: int, said: Column) -> Column:
    if kind == EMAIL:
        return F.lower(F.regexp_extract(said, r"([A-Za-z0-9]+)$", 1)).isin(*TOP_LEVELS)
    if kind == IP:
        return ~F.rlike(said, F.lit(NOT_PUBLIC_IP))
    return F.rlike(said, F.lit(CARD_PREFIX if kind == CARD else AREA))


def _voted(spans: Column, chunks: Column, kind: int, strict: bool) -> Column:
    """Kind, start, end, whether in the base, and the labelers' votes as one number."""

    def vote(span: Column) -> Column:
        base = _valid(kind, span["said"]) if strict else F.lit(False)
        before = _cut(chunks, F.greatest(span["start"] - BEFORE, F.lit(0)), span["start"])
        around = F.concat(
            _cut(chunks, F.greatest(span["start"] - 1, F.lit(0)), span["start"]),
            F.lit(" "),
            _cut(chunks, span["end"], span["end"] + 1),
        )
        cue = F.when(F.rlike(before, F.lit(FOR_WORDS[kind])), 2).when(F.rlike(before, F.lit(AGAINST_WORDS)), 1)
        votes = [
            F.when(base, 2).otherwise(1),
            F.when(_gazetteer(kind, span["said"]), 2).otherwise(1),
            cue.otherwise(0),
            F.when(F.rlike(around, F.lit(r"[\p{L}\p{N}_=/#-]")), 1).otherwise(2),
        ]
        code = sum(v * 3**k for k, v in enumerate(votes))
        return F.struct(
            F.lit(kind).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            base.alias("base"),
            code.cast("int").alias("votes"),
        )

    return F.transform(spans, vote)


def with_candidates(docs: DataFrame, text: str = "text", out: str = "candidates") -> DataFrame:
    """The documents with an array of candidate spans; null text has none."""
    body = F.coalesce(F.col(text), F.lit(""))
    sought = [(k, True) for k in range(4)] + [(k, False) for k in WIDE]
    located = F.array(*[_located(body, (STRICT if strict else WIDE)[k], NEEDS.get((k, strict))) for k, strict in sought])

    def voted(spans: Column) -> Column:
        def each(chunks: Column) -> Column:
            every = [_voted(F.get(spans, i), chunks, k, strict) for i, (k, strict) in enumerate(sought)]
            return F.flatten(F.array(*every)).cast(_CANDIDATE)

        none = F.array().cast(_CANDIDATE)
        return F.when(F.exists(spans, lambda x: F.size(x) > 0), _let(_chunks(body), each)).otherwise(none)

    return docs.withColumn(out, _let(located, voted))


def _split(code: int) -> list[int]:
    return [code // 3**k % 3 for k in range(LABELERS)]


def estimate(counts: dict[int, int]) -> dict[int, float]:
    """Per vote pattern the probability of personal data, by expectation-maximisation.

    Votes are 0 (none), 1 (against) and 2 (for); labelers err independently of each
    other given the truth. ``counts`` is of one kind.
    """
    share = 0.5
    prior = [[0.2, 0.8 * PRIOR_ACCURACY, 0.8 * (1 - PRIOR_ACCURACY)], [0.2, 0.8 * (1 - PRIOR_ACCURACY), 0.8 * PRIOR_ACCURACY]]
    chance = [[list(prior[c]) for _ in range(LABELERS)] for c in (0, 1)]
    truth: dict[int, float] = {}
    for _ in range(ROUNDS):
        for code in counts:
            log = [math.log(1 - share), math.log(share)]
            for c in (0, 1):
                log[c] += sum(math.log(chance[c][k][v]) for k, v in enumerate(_split(code)))
            truth[code] = 1 / (1 + math.exp(min(700.0, log[0] - log[1])))
        total = sum(counts.values())
        share = (sum(n * truth[x] for x, n in counts.items()) + 1) / (total + 2)
        for c in (0, 1):
            for k in range(LABELERS):
                votes = [PRIOR_VOTES * p for p in prior[c]]
                for code, n in counts.items():
                    votes[_split(code)[k]] += n * (truth[code] if c else 1 - truth[code])
                chance[c][k] = [v / sum(votes) for v in votes]
    return truth


def classify(counts: dict[int, int], truth: dict[int, float]) -> dict[int, float]:
    """A logistic classifier of spans over their votes, trained on the estimated truth."""
    weights = [0.0] * (3 * LABELERS)
    total = sum(counts.values()) or 1
    places = {code: [3 * k + v for k, v in enumerate(_split(code))] for code in counts}

    def score(code: int) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[p] for p in places[code])))))

    for _ in range(500):
        slope = [-1e-4 * w for w in weights]
        for code, n in counts.items():
            gap = (truth[code] - score(code)) * n / total
            for p in places[code]:
                slope[p] += gap
        weights = [w + 2.0 * s for w, s in zip(weights, slope)]
    return {code: score(code) for code in counts}


def learnt(candidates: DataFrame, column: str = "candidates") -> list[int]:
    """The vote patterns (with their kind) of spans to add to the base."""
    each = candidates.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes").count()
    counts: dict[int, dict[int, int]] = {}
    for kind, votes, n in each.collect():  # at most 4 kinds x 81 patterns
        counts.setdefault(kind, {})[votes] = n
    accepted = []
    for kind, of_kind in counts.items():
        chance = classify(of_kind, estimate(of_kind))
        # Words before a span must speak for it: a bare number of the right length is not enough.
        cued = {code: p for code, p in chance.items() if _split(code)[CONTEXT] == 2}
        accepted += [kind * 3**LABELERS + code for code, p in cued.items() if p >= ACCEPTED]
    return sorted(accepted)


def _place(c: Column) -> Column:
    return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))


def decided(accepted: list[int], column: str = "candidates") -> Column:
    """All spans, by kind and start: the base, and accepted others that overlap none of it."""
    codes = F.array(*[F.lit(x) for x in accepted]).cast("array<int>")
    base = F.transform(F.filter(column, lambda c: c["base"]), _place)
    others = F.transform(
        F.filter(column, lambda c: ~c["base"] & F.array_contains(codes, c["kind"] * 3**LABELERS + c["votes"])), _place
    )

    def edge(at: str, fixed: bool):
        def of(s: Column) -> Column:
            return F.struct(s[at].alias("at"), F.lit(fixed).alias("fixed"), s.alias("span"))

        return of

    def clear(edges: Column) -> Column:
        # Base spans by their start, others by their end: an other overlaps none of the
        # base if no base span that starts before its end ends after its start.
        ends = F.transform(edges, lambda e: F.when(e["fixed"], e["span"]["end"]).otherwise(0))
        return _let(
            _let(ends, lambda x: _before(x, F.greatest)),
            lambda past: F.filter(edges, lambda e, i: e["fixed"] | (F.get(past, i) <= e["span"]["start"])),
        )

    def swept(x: Column) -> Column:
        edges = F.concat(F.transform(x["base"], edge("start", True)), F.transform(x["others"], edge("end", False)))
        left = F.transform(_let(F.array_sort(edges), clear), lambda e: e["span"])
        return F.array_sort(F.when(F.size(x["others"]) > 0, left).otherwise(x["base"]))

    return _let(F.struct(base.alias("base"), others.alias("others")), swept)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def span_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and the digest are of the base spans; ``spans`` lists all as
    ``kind:start:end`` (code points, end exclusive). A null text is empty and has none;
    repeated rows are a row each; an empty table gives no rows; other columns are not used;
    a long text takes time in proportion to its length and its matches. Candidates are found
    once per text and stored without it.
    """
    found = stored(with_candidates(docs.select("doc_id", "text")).select("doc_id", "candidates"), "candidates")
    base = F.array_sort(F.transform(F.filter("candidates", lambda c: c["base"]), _place))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counted = {f"n_{name}": count(kind) for kind, name in enumerate(KINDS)}
    return (
        found.withColumns({"base": base, "all": decided(learnt(found))})
        .withColumns(counted)
        .select(
            "doc_id",
            *counted,
            F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
            _listed(F.col("all")).alias("spans"),
        )
    )


def _merged(spans: Column) -> Column:
    """Spans by start, those that overlap as one, of the first one's kind."""

    def joined(past: Column) -> Column:
        each = F.transform(
            spans, lambda s, i: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.get(past, i).alias("past"))
        )
        longest = F.array_max(F.transform(spans, lambda s: s["end"]))

        def ended(firsts: Column) -> Column:
            return F.transform(
                firsts,
                lambda f, i: F.struct(
                    f["start"].alias("start"),
                    F.coalesce(F.get(firsts, i + 1)["past"], longest).alias("end"),
                    f["kind"].alias("kind"),
                ),
            )

        return _let(F.filter(each, lambda f: f["start"] >= f["past"]), ended)

    ends = F.transform(spans, lambda s: s["end"])
    return _let(_let(ends, lambda e: _before(e, F.greatest)), joined).cast(_PLACE)


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars follows.

    Spans that overlap become one, named after the first. Documents without spans, null and
    empty texts among them, are unchanged; repeated rows are a row each; an empty table stays
    one. Columns stay as they are, whatever others there are.
    """
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("row"), F.coalesce("text", F.lit("")).alias("body"))
    accepted = learnt(stored(with_candidates(packed, "body").select("candidates"), "candidates"))
    spans = F.array_sort(
        F.transform(
            decided(accepted), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    kind_names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def text(chunks: Column) -> Column:
        def replaced(s: Column, i: Column) -> Column:
            begin = F.when(i > 0, F.get(F.col("merged"), i - 1)["end"]).otherwise(0)
            return F.concat(_cut(chunks, begin, s["start"]), F.get(kind_names, s["kind"]))

        last = F.get("merged", F.size("merged") - 1)["end"]
        return F.concat(F.array_join(F.transform("merged", replaced), ""), _cut(chunks, last, F.length("body")))

    changed = F.size("merged") > 0
    out = (
        with_candidates(packed, "body")
        .withColumn("spans", spans)
        .withColumn("merged", _merged(F.col("spans")))
        .withColumn("clean", F.when(changed, _let(_chunks(F.col("body")), text)).otherwise(F.col("row.text")))
    )
    columns = []
    for name in names:
        column = F.col("row")[name]
        if name == "text":
            column = F.col("clean")
        elif name == "n_chars":
            column = F.when(changed, F.length("clean").cast(docs.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return out.select(*columns)
