"""Conversations as one training text each, proved by reading them back.

The template encloses every turn in control strings:

    user       [INST]text[/INST]
    system     [SYS]text[/SYS]
    assistant  <s>text</s>
    others     [ROLE]role[/ROLE][TEXT]text[/TEXT]

A parser of this grammar cuts a rendered text at every control string, wherever it comes
from, and takes the pieces in pairs: what is between an opening and its closing string is
content, and nothing may stand elsewhere. It is deterministic: the next control string
alone decides.

A turn is rendered as it is first, read back and compared with its source. Where they
differ - its text or role holds a control string, or what looks like an escaped one - the
turn is rendered anew with its content escaped, and read back again; a turn that still
differed would end the job. The escape puts a backslash after the bracket of each control
string, also of one that has backslashes there already; reading takes one away. Turns are
checked before they are put together, each where it lies, and every conversation once more
as a whole.

Everything is a DataFrame expression: no Python runs on the executors. Turns are put in
order by a window that spills, with the bytes before each turn as a running sum; the turns
of one conversation then become one row, as they become one text.

What comes out: ``formatted``, and ``loss_spans``, the byte ranges (UTF-8, end excluded) of
assistant contents in it, as they stand there.

Null roles and texts are empty; a null role is a role without name. Turns are ordered by
turn, null first, then by role and text; equal rows stay repeated turns. Rows with a null
conv_id are one conversation with a null id. Texts of any length are taken whole; one
conversation must fit Spark's row, 2 GB. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.binding import let

# Control strings by what they enclose: opening and closing.
USER, SYSTEM, ASSISTANT = ("[INST]", "[/INST]"), ("[SYS]", "[/SYS]"), ("<s>", "</s>")
ROLE, TEXT = ("[ROLE]", "[/ROLE]"), ("[TEXT]", "[/TEXT]")
OF_ROLE = {"user": USER, "system": SYSTEM, "assistant": ASSISTANT}

# The same as patterns: a control string, and the bracket of one with or without escape.
# They begin with the bracket itself, which rules out most places at once.
CONTROL = r"[\[<](?:(?<=\[)/?(?:INST|SYS|ROLE|TEXT)\]|(?<=<)/?s>)"
PLAIN = r"[\[<](?:(?<=\[)(?=\\*+/?(?:INST|SYS|ROLE|TEXT)\])|(?<=<)(?=\\*+/?s>))"
ESCAPED = r"([\[<])\\(?:(?<=\[\\)(?=\\*+/?(?:INST|SYS|ROLE|TEXT)\])|(?<=<\\)(?=\\*+/?s>))"

TURN = "struct<role:string,text:string>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def parts(role: Column, text: Column) -> dict[str, Column]:
    """A turn's text, what stands before it, and what after it."""
    head = F.concat(F.lit(ROLE[0]), role, F.lit(ROLE[1] + TEXT[0]))
    tail = F.lit(TEXT[1])
    for name, (opening, closing) in OF_ROLE.items():
        head = F.when(role == name, F.lit(opening)).otherwise(head)
        tail = F.when(role == name, F.lit(closing)).otherwise(tail)
    return {"head": head, "body": text, "tail": tail}


def enclosed(kind: tuple[str, str], opening: Column, closing: Column) -> Column:
    return (opening == kind[0]) & (closing == kind[1])


def read_back(text: Column) -> Column:
    """Turns (role, text) of a rendered text; null if the grammar does not allow it.

    Linear in the text: it is cut once, and every pair of control strings is looked at by
    its place.
    """

    def pairs(cut: Column) -> Column:
        marks, pieces = cut["marks"], cut["pieces"]

        def pair(i: Column) -> Column:
            return F.struct(
                F.get(marks, 2 * i).alias("opening"),
                F.get(marks, 2 * i + 1).alias("closing"),
                F.get(pieces, 2 * i).alias("before"),
                F.get(pieces, 2 * i + 1).alias("content"),
            )

        n = F.size(marks)
        places = F.slice(F.sequence(F.lit(0), F.floor(n / 2).cast("int")), 1, F.floor(n / 2).cast("int"))
        return F.when((n % 2 == 0) & (F.get(pieces, n) == ""), F.transform(places, pair))

    def turns(found: Column) -> Column:
        def is_kind(p: Column, *kinds: tuple[str, str]) -> Column:
            return reduce(Column.__or__, [enclosed(k, p["opening"], p["closing"]) for k in kinds])

        def allowed(p: Column, i: Column) -> Column:
            after_role = (i > 0) & F.coalesce(is_kind(F.get(found, i - 1), ROLE), F.lit(False))
            before_text = F.coalesce(is_kind(F.get(found, i + 1), TEXT), F.lit(False))
            known = is_kind(p, *OF_ROLE.values()) & ~after_role
            named = (is_kind(p, ROLE) & before_text & ~after_role) | (is_kind(p, TEXT) & after_role)
            return (p["before"] == "") & (known | named)

        def turn(p: Column, i: Column) -> Column:
            role = unescaped(F.get(found, i - 1)["content"])
            for name, kind in OF_ROLE.items():
                role = F.when(p["opening"] == kind[0], F.lit(name)).otherwise(role)
            return F.struct(role.alias("role"), unescaped(p["content"]).alias("text"), (p["opening"] != ROLE[0]).alias("is_turn"))

        all_allowed = F.forall(F.transform(found, allowed), lambda ok: ok)
        read = F.filter(F.transform(found, turn), lambda t: t["is_turn"])
        return F.when(all_allowed, F.transform(read, lambda t: F.struct(t["role"], t["text"])).cast(f"array<{TURN}>"))

    cut = F.struct(
        F.regexp_extract_all(text, F.lit(f"({CONTROL})")).alias("marks"),
        F.split(text, CONTROL, -1).alias("pieces"),
    )
    return let(let(cut, pairs), turns)


def is_recovered(text: Column, turns: Column) -> Column:
    """Whether the rendered text reads back as exactly these turns."""
    return F.coalesce(read_back(text) == turns.cast(f"array<{TURN}>"), F.lit(False))


def render_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of every turn, and its rendered parts head, body and tail.

    Content is escaped where the turn as it is cannot be read back.
    """
    role, text = F.col("role"), F.col("text")
    made = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns(parts(role, text))
    again = F.when(role.isin(list(OF_ROLE)), role).otherwise(escaped(role))
    for head, body, tail in (parts(again, escaped(text)).values(), (None, None, None)):
        read = F.concat("head", "body", "tail")
        fits = is_recovered(read, F.array(F.struct("role", "text")))
        if "fits" in made.columns:
            fits = F.when(F.col("fits"), True).otherwise(fits)
        made = made.withColumn("fits", fits)
        if head is None:
            wrong = F.raise_error(F.lit("a turn can't be read back")).cast("string")
            made = made.withColumn("body", F.when(F.col("fits"), F.col("body")).otherwise(wrong))
        else:
            better = {"head": head, "body": body, "tail": tail}
            made = made.withColumns({c: F.when(F.col("fits"), F.col(c)).otherwise(b) for c, b in better.items()})
    return made.drop("fits")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans (array of start and end byte) of every conversation."""
    turns = render_turns(conversations)
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    size = F.octet_length("head") + F.octet_length("body") + F.octet_length("tail")
    before = F.coalesce(
        F.sum(size.cast("long")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")
    )
    start = F.col("before") + F.octet_length("head")
    span = F.when(
        F.col("role") == "assistant",
        F.struct(start.alias("start"), (start + F.octet_length("body")).alias("end")),
    )
    placed = turns.withColumn("before", before).select(
        "conv_id",
        F.struct(
            "before",
            F.concat("head", "body", "tail").alias("block"),
            span.alias("span"),
            F.struct("role", "text").alias("turn"),
        ).alias("placed"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("placed")).alias("turns"))
    formatted = F.array_join("turns.block", "")
    spans = F.filter("turns.span", lambda s: s.isNotNull())
    rows = gathered.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"), F.col("turns.turn").alias("turns"))
    checked = F.when(is_recovered(F.col("formatted"), F.col("turns")), F.col("formatted"))
    safe = F.coalesce(checked, F.raise_error(F.lit("a conversation can't be read back")).cast("string"))
    return rows.select("conv_id", safe.alias("formatted"), "loss_spans")


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, one span after the other, as it was before rendering."""

    def under(data: Column) -> Column:
        return F.transform(
            spans,
            lambda s: unescaped(F.decode(F.substring(data, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "UTF-8")),
        )

    return F.array_join(let(F.encode(formatted, "UTF-8"), under), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What the output of :func:`format_conversations` amounts to, read back from it alone."""
    turns = read_back(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_awkward(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose texts are control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    more = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(more)
