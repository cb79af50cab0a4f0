"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by turn, adjacent turns of the same role are merged with an
array aggregation, and the result is concatenated. The template is

    <turn ROLE>⏎text<cut>text</turn>⏎

with one ``<turn>`` for each run of a role and ``<cut>`` between the texts merged into it. Inside texts ``\\`` becomes
``\\b`` and ``<`` becomes ``\\l`` (in roles also ``>`` ``\\g``), so that no control string can occur in them; replacing back in
the opposite order gives the text again. The loss mask is an array of code-point spans, one for each assistant text.

A conversation is cut into segments of ``BLOCK`` rows, one output row each, so that a task never holds more than a segment. Where a run of
a role begins and ends is marked over the whole conversation, by a window that streams through it; a run that crosses segments
is neither closed nor opened again, so the segments in order are the formatted conversation, however it is cut.

Defined cases: null text and null role count as empty; rows with equal turn numbers are ordered by role and text; repeated rows
are repeated turns; a null conv_id is a conversation like another; a null turn comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.llm.shared import text_of

#: Rows of one segment.
BLOCK = 256
#: The role whose texts are learned.
LEARNED = "assistant"
HEAD, HEAD_END, CUT, END = "<turn ", ">\n", "<cut>", "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\g"), F.lit(">")))


def format_chat(conversations: DataFrame) -> DataFrame:
    """One row per conversation and segment: conv_id, segment, formatted, loss_spans (start, end: code points in formatted)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of().alias("text"))
    role = F.col("role")
    rows = rows.select(
        "conv_id", F.floor((F.row_number().over(order) - 1) / BLOCK).alias("segment"),
        F.struct("turn", "role", "text", (~role.eqNullSafe(F.lag("role").over(order))).alias("first"), (~role.eqNullSafe(F.lead("role").over(order))).alias("last"),
                 F.row_number().over(order).alias("row")).alias("t"))
    turns = rows.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list(F.struct(F.col("t.row").alias("row"), "t"))).alias("rows"))
    turns = turns.select("conv_id", "segment", F.col("rows.t").alias("turns"))
    runs = F.aggregate(
        "turns", F.array().cast("array<struct<role:string,texts:array<string>,first:boolean,last:boolean>>"),
        lambda done, t: F.when(
            (F.size(done) > 0) & ~t["first"],
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                t["role"].alias("role"), F.concat(F.element_at(done, -1)["texts"], F.array(t["text"])).alias("texts"), F.element_at(done, -1)["first"].alias("first"), t["last"].alias("last")))),
        ).otherwise(F.concat(done, F.array(F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"), t["first"].alias("first"), t["last"].alias("last"))))))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("s"), loss.alias("loss"))

    def pieces(run: Column) -> Column:
        """A run's texts, with its header where it begins and its end where it ends."""
        texts = F.flatten(F.transform(run["texts"], lambda t, i: F.array(
            piece(F.when((i > 0) | ~run["first"], F.lit(CUT)).otherwise(F.lit("")), F.lit(False)), piece(escaped(t), run["role"] == LEARNED))))
        head = piece(F.when(run["first"], F.concat(F.lit(HEAD), escaped_role(run["role"]), F.lit(HEAD_END))).otherwise(F.lit("")), F.lit(False))
        return F.concat(F.array(head), texts, F.array(piece(F.when(run["last"], F.lit(END)).otherwise(F.lit("")), F.lit(False))))

    parts = turns.select("conv_id", "segment", F.flatten(F.transform(runs, pieces)).alias("parts"))
    spans = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["s"])).alias("at"),
            F.when(p["loss"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), (a["at"] + F.length(p["s"])).alias("end")))))
            .otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    return parts.select("conv_id", "segment", F.array_join("parts.s", "").alias("formatted"), spans.alias("loss_spans"))


def parse_chat(formatted: DataFrame) -> DataFrame:
    """The turns of each segment and the unescaped texts under its loss mask, from a stored output of ``format_chat``. A segment that
    goes on with a run takes its role from the last header before it, which is a window over the headers alone."""
    def turns(run: Column, going: Column) -> Column:
        """The turns of a run, cut off before its end; one without header goes on with the role ``going`` after a cut."""
        headed = run.startswith(HEAD)
        head, body = F.split(run, HEAD_END, 2)[0], F.split(run, HEAD_END, 2)[1]
        role = F.when(headed, unescaped_role(F.substr(head, F.lit(len(HEAD) + 1)))).otherwise(going)
        texts = F.when(headed, body).otherwise(F.substr(run, F.lit(len(CUT) + 1)))
        return F.transform(F.split(texts, CUT, -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    last = F.element_at(F.split("formatted", HEAD, -1), -1)
    has = F.instr("formatted", HEAD) > 0
    last_role = F.when(has, unescaped_role(F.split(last, HEAD_END, 2)[0]))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    rows = formatted.withColumn("_role", last_role).withColumn("_going", F.last("_role", ignorenulls=True).over(before))
    runs = F.filter(F.split("formatted", END, -1), lambda r: r != "")
    loss = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return rows.select("conv_id", "segment", F.flatten(F.transform(runs, lambda r: turns(r, F.col("_going")))).alias("turns"), loss.alias("loss_texts"),
                       F.length("formatted").alias("formatted_chars"))
