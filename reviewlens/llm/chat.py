"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted, neighbours with the
same role are merged with an array aggregation, and the blocks are concatenated:

    <|im_start|>role
    first text<|im_sep|>next text of the same role<|im_end|>

Control strings inside roles and texts are escaped reversibly: ``&`` becomes
``&amp;`` and ``<|`` becomes ``&lt;|``, so ``<|`` only ever begins a control
string.  The loss mask is an array of ``(start, length)`` in code points of the
formatted text, one range for each assistant text.  ``parse`` reads the turns
back from the formatted text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _role_line(role: Column) -> Column:
    """A role is one line: its line breaks are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _read_role(line: Column) -> Column:
    return unescape(F.replace(line, F.lit("&nl;"), F.lit("\n")))


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss`` (array of start, length).

    Rows are sorted by turn (null first), then role and text, so equal turn
    numbers have a defined order and repeated rows are repeated turns.  A null
    role or text is empty; a null conversation id is a conversation of its own.
    An empty table gives no rows.  Other columns are ignored.
    """
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    blocks = F.expr(
        """aggregate(
             turns,
             cast(array() as array<struct<role string, texts array<string>>>),
             (done, t) -> if(
               size(done) > 0 and element_at(done, -1).role = t.role,
               concat(slice(done, 1, size(done) - 1),
                      array(named_struct('role', t.role,
                                         'texts', concat(element_at(done, -1).texts, array(t.text))))),
               concat(done, array(named_struct('role', t.role, 'texts', array(t.text))))))"""
    )
    merged = sorted_.select("conv_id", blocks.alias("blocks"))
    written = merged.select(
        "conv_id",
        F.transform(
            "blocks",
            lambda b: F.struct(
                (b["role"] == LEARNED_ROLE).alias("learned"),
                F.concat(F.lit(START), _role_line(b["role"]), F.lit("\n")).alias("head"),
                F.transform(b["texts"], escape).alias("texts"),
            ),
        ).alias("blocks"),
    )
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, k: F.struct(
                    b["learned"].alias("learned"),
                    F.when(k == 0, b["head"]).otherwise(F.lit(SEPARATOR)).alias("before"),
                    t.alias("text"),
                    F.when(k == F.size(b["texts"]) - 1, F.lit(END + "\n")).otherwise(F.lit("")).alias("after"),
                ),
            ),
        )
    )
    cut = written.select("conv_id", pieces.alias("pieces"))
    text_of = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), ""
    )
    zero = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,length:int>>").alias("loss"),
    )

    def step(done, p):
        start = done["at"] + F.length(p["before"])
        size = F.length(p["text"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct(
            (start + size + F.length(p["after"])).alias("at"),
            F.when(p["learned"], F.concat(done["loss"], span)).otherwise(done["loss"]).alias("loss"),
        )

    loss = F.aggregate("pieces", zero, step)["loss"]
    return cut.select("conv_id", text_of.alias("formatted"), loss.alias("loss"))


def parse(formatted: Column) -> Column:
    """Array of (role, text), one entry per original turn, from a formatted text."""
    blocks = F.slice(F.split(formatted, "<\\|im_start\\|>"), 2, 1 << 30)

    def turns(block):
        role = F.substring_index(block, "\n", 1)
        body = block.substr(F.length(role) + 2, F.length(block))
        body = body.substr(F.lit(1), F.length(body) - len(END) - 1)
        return F.transform(
            F.split(body, "<\\|im_sep\\|>"),
            lambda t: F.struct(_read_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def masked(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between its parts."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(formatted.substr(s["start"] + 1, s["length"]))), ""
    )
