"""Chat conversations as training examples: one per assistant turn, with all turns before it as context.

A turn reads ``<turn role>`` newline text newline ``</turn>`` newline. Inside roles and texts the backslash and both angle
brackets are escaped, so no text can hold a marker; the escape is undone exactly when examples are read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
HEAD, HEAD_END, TAIL = "<turn ", ">\n", "\n</turn>\n"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\``, ``<`` becomes ``\l`` and ``>`` becomes ``\g``."""
    for plain, escaped in (("\\", "\\\\"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    """The text that `escape` was given."""
    def brackets(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    # A backslash stands first in each pair, so pairs of backslashes are found from the left.
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), brackets), "\\")


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """One row (conv_id, turns) per conversation, ``turns`` an array of (turn, role, text) by turn, then role and text.

    Null roles and texts become empty; null turn numbers come first. Repeated rows are turns of their own.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return turns.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def chat_examples(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """Training examples: ``conv_id``, ``example``, ``text``, ``loss_start`` and ``loss_chars``.

    Every assistant turn gives an example that ends with it; only its text is trainable (code points from ``loss_start``,
    counted from 0). Turns after the last reply, or a conversation without replies, give one more example with
    ``loss_chars`` null, so the examples hold every turn. ``example`` is the number of turns in it. Conversations with a
    null id form one. Other columns are not read. An empty table gives an empty table. A conversation is one row here:
    its contexts repeat by definition, so an example is as long as the turns before it.
    """
    grouped = conversations(turns, id_col, turn_col, role_col, text_col)
    formatted = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), escape(t["text"]).alias("body"),
        F.concat(F.lit(HEAD), escape(t["role"]), F.lit(HEAD_END)).alias("head")))
    rows = grouped.select("conv_id", formatted.alias("turns"))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")),
                    lambda i: (F.get("turns", i - 1)["role"] == ASSISTANT) | (i == F.size("turns")))
    rows = rows.select("conv_id", "turns", F.explode(ends).alias("example"))
    last = F.get("turns", F.col("example") - 1)
    before = F.array_join(F.transform(F.slice("turns", 1, F.col("example") - 1),
                                      lambda t: F.concat(t["head"], t["body"], F.lit(TAIL))), "")
    rows = rows.select("conv_id", "example", F.concat(before, last["head"]).alias("prompt"),
                       last["body"].alias("body"), (last["role"] == ASSISTANT).alias("trained"))
    return rows.select(
        "conv_id", "example", F.concat("prompt", "body", F.lit(TAIL)).alias("text"),
        F.when(F.col("trained"), F.length("prompt")).cast("long").alias("loss_start"),
        F.when(F.col("trained"), F.length("body")).cast("long").alias("loss_chars"))


def read_turns(text: Column) -> Column:
    """Array of (role, text) read back from an example."""
    def turn(part: Column) -> Column:
        role_end = F.locate(HEAD_END, part)
        role = F.substring(part, F.lit(len(HEAD) + 1), role_end - len(HEAD) - 1)
        body = F.substring(part, role_end + len(HEAD_END), F.length(part))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))
    parts = F.split(text, F.lit(TAIL), F.lit(-1))
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: turns, their digest, trainable text and its digest, and all characters.

    Returns ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and ``formatted_chars``.
    """
    reply = unescape(F.substring("text", F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    rows = examples.select("conv_id", "example", "text", reply.alias("reply"))
    per = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"), F.sum(F.length("text")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))).alias("replies"))
    per = per.select("conv_id", "formatted_chars", read_turns(F.col("longest")).alias("turns"),
                     F.array_join(F.col("replies.reply"), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
