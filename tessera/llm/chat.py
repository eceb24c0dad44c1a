"""Chat formatting by event-sourced reconstruction (DataFrame operations only).

A log holds events of conversations: ``message`` starts a message or replaces
it, ``delta`` appends streamed text, ``edit`` replaces the text, ``regenerate``
empties it for the deltas that follow, ``delete`` removes the message.  Rows are
partitioned by conversation once; each message's events are sorted by sequence
number and folded, and the messages of a conversation rendered in order.

Template: ``<s>[INST]role``, line feed, text, ``[/INST]</s>`` for every turn (a
line feed or percent sign in a role is written as %0A or %25).
Inside texts and roles every string that a template reads as control gets a
backslash after its first character (one more if it has some already), which
:func:`unescaped` takes away again: the rendering is unambiguous and reversible.

Defined cases: null texts are empty; a null role is the empty role; null turns
and sequence numbers sort first; rows that tie are ordered by kind, role and
text; rows that share a turn in a plain table are messages of their own; an
empty log gives no conversations; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, CLOSE = "<s>[INST]", "[/INST]</s>"
#: What follows the first character of a control string.
_TAIL = r"(\||/?s>|/?INST\]|</?SYS>>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def _one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _as_given(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def messages(log: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final messages of a log (conv_id, turn, seq, kind, role, text).

    The table is dealt out by conversation once, and stays so for what follows.
    """
    event = F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    start = F.struct(F.lit(False).alias("live"), F.lit("").alias("role"), F.lit("").alias("text"))

    def step(m, e):
        kind = e["kind"]
        role = F.when(e["role"] != "", e["role"]).otherwise(m["role"])
        text = (
            F.when(kind.isin("message", "edit"), e["text"])
            .when(kind == "delta", F.concat(m["text"], e["text"]))
            .when(kind.isin("regenerate", "delete"), F.lit(""))
            .otherwise(m["text"])
        )
        live = F.when(kind == "delete", F.lit(False)).when(kind.isin("message", "edit", "delta", "regenerate"), F.lit(True)).otherwise(m["live"])
        return F.struct(live.alias("live"), role.alias("role"), text.alias("text"))

    grouped = log.repartition("conv_id").groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(event)).alias("events"))
    return (
        grouped.withColumn("m", F.aggregate("events", start, step))
        .filter("m.live")
        .select("conv_id", "turn", F.col("m.role").alias("role"), F.col("m.text").alias("text"))
    )


def rendered(final: DataFrame) -> DataFrame:
    """(conv_id, formatted) of messages (conv_id, turn, role, text)."""
    turn = F.struct("turn", "role", "text")
    shown = F.transform(
        F.sort_array(F.collect_list(turn)),
        lambda m: F.concat(F.lit(OPEN), escaped(_one_line(m["role"])), F.lit("\n"), escaped(m["text"]), F.lit(CLOSE)),
    )
    return final.groupBy("conv_id").agg(F.array_join(shown, "").alias("formatted"))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) that a rendering holds, as an array."""
    cut = F.slice(F.split(formatted, r"<s>\[INST\]"), 2, 1 << 30)
    body = F.transform(cut, lambda x: F.substring_index(x, CLOSE, 1))

    def turn(x):
        return F.struct(
            _as_given(unescaped(F.substring_index(x, "\n", 1))).alias("role"),
            unescaped(F.substr(x, F.length(F.substring_index(x, "\n", 1)) + 2)).alias("text"),
        )

    return F.transform(body, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the renderings (conv_id, formatted) finds in them."""
    turns = formatted.withColumn("turns", parsed(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of(rows: DataFrame) -> DataFrame:
    """A plain table (conv_id, turn, role, text) as a log of whole messages, each row one."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.select("conv_id", place.alias("turn"), F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")


def format_conversations(log: DataFrame) -> DataFrame:
    """(conv_id, formatted) of a log of events."""
    return rendered(messages(log))
