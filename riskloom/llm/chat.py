"""Conversations as training text: a marked-up form that can be read back exactly, and its loss mask.

Grammar. A conversation is its turns in a row; a turn is ``[INST] role [/INST] text </s>``. The marks
stand with the blanks around them. Inside a role or a text a mark is written with a backslash before
it, and one more backslash is put before a mark that already has some; reading takes one away. A real
mark follows a blank or the end of a turn, so no escaped mark can pass for one.

Escaping happens only where it is needed: a turn is rendered plainly, read back and compared with its
source; if they differ it is rendered with one more level of escaping, until they are identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template.
OPEN, MIDDLE, CLOSE = "[INST] ", " [/INST] ", " </s>"
MARK = r"\[/?INST\]|</?s>"
LOSS_ROLE = "assistant"
#: Rounds of escaping: plain, escaped. One level is enough for any text; a turn that still differs fails the job.
ROUNDS = 2


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*(?:{MARK}))", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*(?:{MARK}))", "$1")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), null for a turn that breaks the grammar."""

    def turn(chunk: Column) -> Column:
        parts = F.split(chunk, r" \[/INST\] ", 2)
        body = F.struct(unescape(F.substring(F.element_at(parts, 1), len(OPEN) + 1, 2**31 - 1)).alias("role"),
                        unescape(F.try_element_at(parts, F.lit(2))).alias("text"))
        return F.when(chunk.startswith(OPEN) & (F.size(parts) == 2), body)

    chunks = F.split(formatted, r" </s>")
    # What follows the last closing mark is empty, or the text does not end with one.
    return F.transform(F.slice(chunks, 1, F.size(chunks) - 1), turn)


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    loss_spans lists (start, length), in code points from 0, of the text of each ``loss_role`` turn as it
    stands in ``formatted``, escapes included. Turns follow in the order of ``turn``, nulls first; ties are
    ordered by role and text, and repeated rows are turns of their own. A null role or text is an empty
    one. Rows with a null conv_id form one conversation. Other columns are not read; an empty table gives
    no rows. A conversation is one value of the result, so its rows meet in one task.
    """
    slim = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = F.array(F.struct("role", "text"))
    form = rendered(F.col("role"), F.col("text"))
    slim = slim.select("*", F.struct(form.alias("form"), F.col("role").alias("r"), F.col("text").alias("t")).alias("v"))
    for _ in range(ROUNDS - 1):
        r, t = escape(F.col("v.r")), escape(F.col("v.t"))
        more = F.struct(rendered(r, t).alias("form"), r.alias("r"), t.alias("t"))
        same = F.coalesce(parse(F.col("v.form")) == source, F.lit(False))
        slim = slim.withColumn("v", F.when(same, F.col("v")).otherwise(more))
    differs = ~F.coalesce(parse(F.col("v.form")) == source, F.lit(False))
    form = F.when(differs, F.raise_error(F.lit("a turn cannot be read back"))).otherwise(F.col("v.form"))
    lead = F.length(F.concat(F.lit(OPEN + MIDDLE), F.col("v.r")))
    turns_out = slim.select("conv_id", "turn", "role", "text", form.alias("form"), lead.alias("lead"),
                            F.length("v.t").alias("size"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum(F.length("form")).over(in_order), F.lit(0))
    placed = turns_out.withColumn("at", so_far)
    loss = F.when(F.col("role") == loss_role,
                  F.struct((F.col("at") + F.col("lead")).cast("long").alias("start"), F.col("size").cast("long").alias("length")))
    return placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "form"))).alias("forms"),
        F.array_sort(F.collect_list(loss)).alias("loss_spans"),
    ).select("conv_id", F.concat_ws("", F.col("forms.form")).alias("formatted"), "loss_spans")


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped text under the mask, spans in order with nothing between."""
    cut = F.transform(loss_spans, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.concat_ws("", cut)
