"""Chat formatting from an event log, in DataFrame functions only.

A log holds ``conv_id, message, turn, seq, kind, role, text``. Kinds: ``open`` starts a
message, ``delta`` appends streamed text, ``edit`` puts new text in place of all so far,
``regenerate`` discards the text so far so that deltas stream it anew. Events are folded
per message in the order of ``seq``, messages rendered one by one, and the rendered
turns joined per conversation.

The template gives a turn as ``<|turn|>role NEWLINE text<|end|>NEWLINE``. Inside texts
and roles a backslash goes between ``<`` and ``|`` (one more if there are some already),
so no control string can occur there and the escape can be taken back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the template.
TURN = "<|turn|>"
END = "<|end|>\n"
TRAINED_ROLE = "assistant"
#: What every control string, escaped or not, begins with.
CONTROL = r"<(\\*)\|"
#: Plan parameter: the most code points of a delta. Results are the same for any value.
DELTA_CHARS = 256

LOG = "conv_id long, message long, turn long, seq int, kind string, role string, text string"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """As ``escaped``, and on one line."""
    return F.replace(F.replace(escaped(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def pieces(text: Column) -> Column:
    """The text as it is streamed, in deltas of ``DELTA_CHARS`` code points; one if it is short."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))
    return F.when(F.length(text) > DELTA_CHARS, cut).otherwise(F.array(text))


def turn_log(rows: DataFrame) -> DataFrame:
    """The event log of finished turns: each row opens a message and streams its text in deltas.

    A text with a control string is replaced by its escaped form: one that was said in one
    delta by an ``edit``, a longer one by a ``regenerate`` and the deltas that stream it
    anew. Texts are escaped nowhere else, so the fold decides what is rendered.
    """
    text = F.coalesce("text", F.lit(""))
    nothing = F.lit(None).cast("string")

    def event(seq: Column, kind: str, said: Column, role: Column = nothing) -> Column:
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), said.alias("text"))

    def deltas(said: Column, after: Column) -> Column:
        return F.transform(pieces(said), lambda piece, i: event(after + 1 + i, "delta", piece))

    opened = F.array(event(F.lit(0), "open", nothing, F.col("role")))
    next_seq = F.size(pieces(text)) + 1
    edited = F.array(event(next_seq, "edit", escaped(text)))
    anew = F.concat(F.array(event(next_seq, "regenerate", nothing)), deltas(escaped(text), next_seq))
    replaced = F.when(F.length(text) > DELTA_CHARS, anew).otherwise(edited)
    said = F.concat(opened, deltas(text, F.lit(0)))
    events = F.when(F.regexp_like(text, F.lit(CONTROL)), F.concat(said, replaced)).otherwise(said)
    return (
        rows.select("conv_id", "turn", "role", "text")
        .withColumn("message", F.monotonically_increasing_id())
        .select("conv_id", "message", "turn", F.inline(events))
    )


def folded(log: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, turn, role, text.

    Only events from the last ``open``, ``edit`` or ``regenerate`` on make the text;
    a message without any has all its deltas. Role and turn are those of the ``open``.
    The log is dealt out by conversation once; all that follows stays in place.
    """
    resets = F.col("kind").isin("open", "edit", "regenerate")
    event = F.struct("seq", "kind", resets.alias("reset"), "text")
    opened = F.col("kind") == "open"
    events = log.repartition("conv_id").groupBy("conv_id", "message").agg(
        F.coalesce(F.max(F.when(opened, F.col("turn"))), F.max("turn")).alias("turn"),
        F.max(F.when(opened, F.col("role"))).alias("role"),
        F.sort_array(F.collect_list(event)).alias("events"),
    )
    flags = F.reverse(F.transform("events", lambda e: e["reset"]))
    back = F.array_position(flags, True)
    kept = F.when(back > 0, F.slice("events", F.size("events") - back.cast("int") + 1, back.cast("int")))
    texts = F.transform(F.coalesce(kept, F.col("events")), lambda e: F.coalesce(e["text"], F.lit("")))
    return events.select("conv_id", "message", "turn", "role", F.array_join(texts, "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``loss_spans`` holds start and end, in code points of ``formatted``, of the
    assistant's texts. Turns come by turn; equal turns by role, then text. The messages'
    texts are those of a log like ``turn_log``, whose edits and regenerations have escaped them.
    """
    role = F.coalesce("role", F.lit(""))
    body = F.coalesce("text", F.lit(""))
    chunks = messages.select(
        "conv_id",
        "turn",
        (role == TRAINED_ROLE).alias("trained"),
        F.concat(F.lit(TURN), escaped_role(role), F.lit("\n"), body, F.lit(END)).alias("chunk"),
        F.length(body).alias("n"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "chunk").rowsBetween(Window.unboundedPreceding, 0)
    placed = chunks.withColumn("until", F.sum(F.length("chunk").cast("long")).over(order))
    stop = F.col("until") - len(END)
    span = F.when(F.col("trained"), F.struct((stop - F.col("n")).alias("start"), stop.alias("end")))
    turns = F.sort_array(F.collect_list(F.struct("until", "chunk", span.alias("span"))))
    return placed.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["chunk"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["span"].isNotNull()), lambda t: t["span"]).alias("loss_spans"),
    )


def parsed(formatted: DataFrame) -> DataFrame:
    """The turns read back from ``formatted``: adds ``turns``, an array of role and text."""
    parts = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda _, i: i > 0)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        start = F.length(role) + 2
        said = F.substring(part, start, F.length(part) - start + 1 - len(END))
        return F.struct(unescaped_role(role).alias("role"), unescaped(said).alias("text"))

    return formatted.withColumn("turns", F.transform(parts, turn))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Conversations of a table of turns, through its event log: conv_id, formatted, loss_spans.

    Null text is empty, null role is an empty role, rows of a null conv_id are one
    conversation, null turns come first, repeated rows are turns each; other columns
    are not used; an empty table gives no rows.
    """
    return rendered(folded(turn_log(rows)))


def digests(formatted: DataFrame) -> DataFrame:
    """What the read-back turns say: counts and digests per conversation."""
    back = parsed(formatted)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.filter("turns", lambda t: t["role"] == TRAINED_ROLE)
    loss = F.array_join(F.transform(trained, lambda t: t["text"]), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
