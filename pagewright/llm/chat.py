"""Chat formatting whose output can be read back exactly.

Main path: DataFrame functions only.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. The reader takes one backslash out of every
``<\\...\\|`` of a text, so a writer that puts one in can place any text between the marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.columns import whole

START, END = "<|im_start|>", "<|im_end|>\n"
ESCAPED_ROLE = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("|", "%7C"))


def escape(text: Column) -> Column:
    """No ``<|`` is left: ``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``, and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for plain, code in ESCAPED_ROLE:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in reversed(ESCAPED_ROLE):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def render(turns: Column) -> Column:
    """The formatted text of an array of (role, text), taken as they are."""
    return F.array_join(F.transform(turns, lambda t: render_turn(t["role"], t["text"])), "")


def parse(formatted: Column) -> Column:
    """Turns of a formatted text as array<struct<role, text, start, size>>.

    ``start`` is the 0-based code point at which the text begins in ``formatted`` and ``size`` its
    length there, so the two are the span of the text. An array with a null is returned for a
    string this grammar does not produce.
    """
    pieces = F.split(formatted, r"<\|im_start\|>")
    bodies = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        text = F.substr(body, F.length(role) + 2, F.length(body) - F.length(role) - 1 - len(END))
        whole_turn = F.contains(body, F.lit("\n")) & F.endswith(body, F.lit(END)) & (
            F.length(body) >= F.length(role) + 1 + len(END)
        )
        return F.when(
            whole_turn & ~F.contains(text, F.lit("<|")),
            F.struct(
                unescape_role(role).alias("role"),
                unescape(text).alias("text"),
                F.length(role).alias("head"),
                F.length(text).alias("size"),
                F.length(body).alias("length"),
            ),
        )

    read = F.transform(bodies, turn)
    # running start of each text: lengths of the turns before it, plus mark, role and line end
    located = F.aggregate(
        read,
        F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<role:string,text:string,start:int,size:int>>").alias("turns"),
        ),
        lambda state, t: F.struct(
            (state["at"] + len(START) + t["length"]).alias("at"),
            F.concat(
                state["turns"],
                F.array(
                    F.struct(
                        t["role"].alias("role"),
                        t["text"].alias("text"),
                        (state["at"] + len(START) + t["head"] + 1).alias("start"),
                        t["size"].alias("size"),
                    )
                ),
            ).alias("turns"),
        ),
        lambda state: state["turns"],
    )
    empty = F.array().cast("array<struct<role:string,text:string,start:int,size:int>>")
    return F.when(F.element_at(pieces, 1) != "", F.lit(None)).when(formatted == "", empty).otherwise(located)


def _said(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, text)``.

    ``formatted`` is the text, ``turns`` what the parser reads back from it (role, text, start,
    size), ``loss_spans`` the (start, size) of each text of ``trained_role``, ``escaped`` whether a
    conflict was found. Each turn is rendered as it is and read back by the same parser; a turn that
    does not come back identical is escaped. The whole conversation is then read back once more and
    an error is raised if it still differs.

    Null roles and texts are empty, a null ``conv_id`` is a conversation of its own. Turns are
    ordered by (turn, role, text), nulls first; repeated rows are repeated turns. No rows give no
    conversations. Further columns are ignored.
    """
    plain = turns.select(
        "conv_id", "turn", whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text")
    )
    alone = parse(render_turn(F.col("role"), F.col("text")))
    same = F.coalesce(
        (F.size(alone) == 1)
        & (F.element_at(alone, 1)["role"] == F.col("role"))
        & (F.element_at(alone, 1)["text"] == F.col("text")),
        F.lit(False),
    )
    # a text without these three needs no parser to come back as it is
    suspect = F.contains("text", F.lit("<")) | F.col("role").rlike(r"[%\n<|]")
    safe = plain.withColumn("conflict", F.when(suspect, ~same).otherwise(False)).select(
        "conv_id",
        "turn",
        "role",
        "text",
        "conflict",
        F.when(F.col("conflict"), escape_role(F.col("role"))).otherwise(F.col("role")).alias("safe_role"),
        F.when(F.col("conflict"), escape(F.col("text"))).otherwise(F.col("text")).alias("safe_text"),
    )
    grouped = safe.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "safe_role", "safe_text"))).alias("source"),
        F.max("conflict").alias("escaped"),
    )
    formatted = grouped.withColumn(
        "formatted",
        F.array_join(F.transform("source", lambda t: render_turn(t["safe_role"], t["safe_text"])), ""),
    )
    read = formatted.withColumn("turns", parse(F.col("formatted")))
    proven = F.when(_said(F.col("turns")) == _said(F.col("source")), F.col("turns")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not read back as its source")).cast(
            "array<struct<role:string,text:string,start:int,size:int>>"
        )
    )
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == trained_role),
        lambda t: F.struct(t["start"].alias("start"), t["size"].alias("size")),
    )
    return read.withColumn("turns", proven).select("conv_id", "formatted", "turns", "escaped", spans.alias("loss_spans"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["size"]))), ""
    )
