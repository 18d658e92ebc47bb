"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A turn is written ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside texts every ``<|``
gets a backslash between its two characters (one more where some stand
there already), so no text can hold a control string and the original is
restored exactly; roles are URL-encoded, so they hold no line end.

Every assistant turn becomes an example of its own: all turns before it as
context, and that reply as the only trainable part. Turns after the last reply,
and conversations without one, are kept as one more row without a target, so the
output holds every turn.

Defined cases: a null text or role is empty; turns of equal number are ordered by
role and text and all kept, a null number comes first; rows with a null
conversation id are one conversation; an empty table gives an empty result;
further columns are ignored. A conversation is put together in one row, as its
digest needs it whole; examples are cut from that row and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end, complete): one row per
    reply, and one for turns after the last reply. ``loss_start`` and ``loss_end``
    are code point offsets in ``formatted`` (null: nothing to train on); ``complete``
    tells that the row holds the whole conversation."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"),
                        escape(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n"), t["text"], F.lit(END)))
    talks = talks.select("conv_id", "turns", parts.alias("parts"), F.size("turns").alias("n"))
    each = talks.select("conv_id", "n", "parts", F.posexplode("turns").alias("at", "turn"))
    reply = F.col("turn.role") == target_role
    last = F.col("at") == F.col("n") - 1
    each = each.filter(reply | last).select(
        "conv_id", "at", F.array_join(F.slice("parts", 1, F.col("at") + 1), "").alias("formatted"),
        F.when(reply, F.length("turn.text")).alias("size"), last.alias("complete"))
    end = F.when(F.col("size").isNotNull(), F.length("formatted") - len(END))
    return each.select("conv_id", F.col("at").alias("example"), "formatted",
                       (end - F.col("size")).alias("loss_start"), end.alias("loss_end"), "complete")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string, as they were given."""
    segments = F.split(formatted, r"<\|im_end\|>\n")
    segments = F.slice(segments, 1, F.size(segments) - 1)

    def of(segment: Column) -> Column:
        body = F.substring(segment, F.lit(len(START) + 1), F.length(segment))
        name = F.substring_index(body, "\n", 1)
        return F.struct(F.url_decode(name).alias("role"),
                        unescape(F.substring(body, F.length(name) + 2, F.length(body))).alias("text"))

    return F.transform(segments, of)


def read_back(rows: DataFrame) -> DataFrame:
    """Per conversation of :func:`examples`' output: turns, digests of all turns and
    of the text under the loss mask, and code points of what was written."""
    told = F.array_join(F.transform(parse(F.col("formatted")),
                                    lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    reply = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    each = rows.select("conv_id", "example", F.length("formatted").cast("long").alias("chars"), reply.alias("reply"),
                       F.when(F.col("complete"), F.size(F.split("formatted", r"<\|im_end\|>\n")) - 1).alias("n"),
                       F.when(F.col("complete"), F.sha2(told, 256)).alias("sha"))
    talks = each.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))).alias("replies"),
        F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    return talks.select("conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"),
                        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
                        F.size("replies").cast("long").alias("n_examples"))
