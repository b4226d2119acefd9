"""Chat conversations as training examples, one for each assistant turn.

Every assistant turn becomes an example of its own: all turns before it are context, and only that reply is trainable.
The template marks turns with control strings; inside texts and roles these are escaped, so that no text can end a turn
or start one, and an example can be read back exactly. All of it is SQL functions.

Escapes: a backslash is doubled, then ``<|`` gets a backslash between its characters. In a role a line feed is written
as a backslash and ``n`` between angle brackets. Single backslashes after ``<`` occur in escapes only, so undoing them
in the opposite order gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Training examples: ``conv_id, example, text, loss_start, loss_chars, is_last``.

    ``text`` is the formatted conversation up to the turn that is trained, and ``loss_start``, ``loss_chars`` mark that
    turn's escaped text in it, in code points. Turns after the last assistant turn, and conversations without one, give a
    last example without a trained part, so that every turn is in ``is_last``. Null texts and roles are empty. Turns with
    the same number are ordered by role and text, and repeated rows count each time; rows without a conversation id form
    one conversation with a null id. Other columns are ignored.
    """
    parts = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("part"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    shown = whole.select(
        "conv_id",
        F.transform("parts", lambda p: F.struct(
            F.concat(F.lit(START), escape_role(p["role"]), F.lit("\n")).alias("head"),
            escape(p["text"]).alias("body"), (p["role"] == TRAINED).alias("trained"))).alias("parts"))
    shown = shown.select("conv_id", "parts", F.size("parts").alias("n"), F.transform(
        "parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))).alias("lines"))
    each = shown.select("conv_id", "n", "lines", F.posexplode("parts").alias("at", "part")).where(
        F.col("part.trained") | (F.col("at") == F.col("n") - 1))
    before = F.array_join(F.slice("lines", F.lit(1), F.col("at")), "")
    cut = each.select("conv_id", "at", "n", "part", before.alias("before"))
    return cut.select(
        "conv_id", F.col("at").alias("example"),
        F.concat("before", "part.head", "part.body", F.lit(END)).alias("text"),
        (F.length("before") + F.length("part.head")).alias("loss_start"),
        F.when(F.col("part.trained"), F.length("part.body")).otherwise(0).alias("loss_chars"),
        (F.col("at") == F.col("n") - 1).alias("is_last"))


def read_turns(text: Column) -> Column:
    """Turns read back from an example: an array of ``role, text``."""
    blocks = F.split(text, "<\\|im_end\\|>\n")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(START) + 1)), "\n", 1)
        body = F.substr(block, F.length(role) + len(START) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, turn)


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """The trained text, read back through the loss mask."""
    return unescape(F.substr(text, start + 1, chars))


def read_back(shaped: DataFrame) -> DataFrame:
    """What :func:`examples` holds of each conversation, read from the formatted texts alone."""
    read = F.transform(read_turns(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = shaped.select(
        "conv_id", "example", F.length("text").alias("chars"), F.when(F.col("is_last"), read).alias("read"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss"))
    rows = rows.select("conv_id", "example", "chars", "loss", F.size("read").alias("n"),
                       F.sha2(F.array_join("read", ""), 256).alias("digest"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda e: e["loss"])
    out = rows.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("digest").alias("turns_sha256"),
        F.array_join(ordered, "").alias("loss"), F.sum("chars").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
