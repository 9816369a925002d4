"""Chat formatting with a grammar round trip, in DataFrame functions alone.

Template of a turn: ``### <Role>: `` text `` </turn>`` newline. Control strings are the header mark
(``### ``) and the end mark (``</turn>``). A text is first taken as it is, the rendered turn is
reparsed by the deterministic parser, and where the recovered turn differs the control strings in
it get one backslash inside (``##\\# ``, ``<\\/turn>``; one more where there are some already). The
parser takes one backslash out again, so an escaped text always comes back identical: escaping a
text puts at least one backslash in every control string and keeps its number of backslashes
recoverable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, MARK = "### ", "</turn>"
END = MARK + "\n"
#: Roles whose text bears loss.
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """One more backslash inside every control string."""
    return F.regexp_replace(F.regexp_replace(text, r"##(\\*)# ", r"##\\$1# "), r"<(\\*)/turn>", r"<\\$1/turn>")


def unescape(text: Column) -> Column:
    """One backslash less inside every control string that has some."""
    return F.regexp_replace(F.regexp_replace(text, r"##\\(\\*)# ", r"##$1# "), r"<\\(\\*)/turn>", r"<$1/turn>")


def _role_out(role: Column) -> Column:
    """A role as it stands in a header: reserved characters percent-encoded, first letter marked by case."""
    for plain, coded in (("%", "%25"), (":", "%3A"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    known = F.when(role == "assistant", "Assistant").when(role == "user", "User").when(role == "system", "System")
    return F.coalesce(known, F.concat(F.lit("="), role))


def _role_in(name: Column) -> Column:
    known = F.when(name == "Assistant", "assistant").when(name == "User", "user").when(name == "System", "system")
    role = F.substring(name, 2, 1 << 30)
    for plain, coded in (("\n", "%0A"), ("<", "%3C"), (":", "%3A"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return F.coalesce(known, role)


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEADER), _role_out(role), F.lit(": "), body, F.lit(" "), F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a rendered text: array of (role, text, body, at).

    The grammar is regular: a text is a run of turns, each up to the next end mark; a turn is a header
    mark, a role up to the first colon and blank, and a body without control strings; anything else
    is no turn (role null). ``body`` is the text as escaped and ``at`` its place in the turn (from 1).
    """
    parts = F.split(formatted, END, -1)
    turns = F.slice(parts, 1, F.size(parts) - 1)

    def turn(t: Column) -> Column:
        head = F.instr(t, ": ")
        name = F.substring(t, 1, head - 1)
        body = F.substring(t, head + 2, F.length(t) - head - 2)
        legal = F.startswith(name, F.lit(HEADER)) & ~F.contains(body, F.lit(HEADER)) & ~F.contains(body, F.lit(MARK))
        role = F.when(legal, _role_in(F.substring(name, len(HEADER) + 1, 1 << 30)))
        return F.struct(
            role.alias("role"),
            unescape(body).alias("text"),
            body.alias("body"),
            (head + 2).alias("at"),
            (F.length(t) + len(END)).alias("size"),
        )

    return F.transform(turns, turn)


def conflict_free(role: Column, text: Column) -> Column:
    """The first of ``text`` and its escaped form whose rendered turn reparses to (role, text); an error if neither
    does."""

    def same(body: Column) -> Column:
        got = parse(render_turn(role, body))
        return (F.size(got) == 1) & got[0]["role"].eqNullSafe(role) & got[0]["text"].eqNullSafe(text)

    escaped = escape(text)
    failed = F.raise_error(F.lit("a turn does not reparse to its source")).cast("string")
    return F.when(same(text), text).when(same(escaped), escaped).otherwise(failed)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (from 0, in code points), round_trip.

    Turns are ordered by turn, then role and text, so ties and repeated rows have a fixed order (all
    are kept). Null texts and roles are empty; a null turn comes first; rows with a null conv_id make one conversation.
    Other columns are not read; an empty table gives an empty table. Texts are escaped before the shuffle, turn by turn; a
    conversation is the unit of output and is gathered once. ``round_trip`` compares all recovered turns with the source.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.select(
        "conv_id",
        F.struct("turn", "role", "text", conflict_free(F.col("role"), F.col("text")).alias("body")).alias("t"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    formatted = turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: render_turn(t["role"], t["body"])), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    parsed = formatted.withColumn("parsed", parse(F.col("formatted")))
    begin = F.aggregate(
        "parsed",
        F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        _span,
    )
    back = F.transform("parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return parsed.select(
        "conv_id", "formatted", begin["spans"].alias("loss_spans"), back.eqNullSafe(F.col("source")).alias("round_trip")
    )


def _span(state: Column, t: Column) -> Column:
    here = F.struct((state["next"] + t["at"] - 1).cast("int").alias("start"), F.length(t["body"]).alias("length"))
    spans = F.when(t["role"].isin(*LOSS_ROLES), F.concat(state["spans"], F.array(here))).otherwise(state["spans"])
    return F.struct((state["next"] + t["size"]).cast("int").alias("next"), spans.alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests recovered from the formatted text and its loss mask alone: n_turns, turns_sha256 (role,
    newline, text, newline per turn), loss_chars, loss_sha256 (unescaped texts under the mask) and formatted_chars."""
    parsed = formatted.withColumn("parsed", parse(F.col("formatted")))
    turns = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""
    )
    texts = parsed.select(
        "conv_id",
        F.size("parsed").cast("bigint").alias("n_turns"),
        turns.alias("turns"),
        loss.alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "round_trip",
    )
    return texts.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "round_trip",
    )
