"""Chat transcripts as training texts with a loss mask, by array expressions only.

The turns of a conversation are collected as structs, sorted, and written with one header per run of equal roles; the
texts of such a run are set apart by a mark, so the formatted text tells every turn. Control strings inside texts and
roles are escaped reversibly: a `~` goes after their first character (`<~|`, `[~INST]`); one `~` more where there are some already.
A role is one line: its line breaks are written `\\n` and its backslashes `\\b`, each as two characters.

The output of a conversation is the list of `segments` (text, loss) and their concatenation `formatted`; `loss` is true for
exactly the assistant's texts. A conversation is one output row by nature.

Nulls and ties: a null text or role is empty; turns are ordered by turn (null first), then role, then text; repeated
rows are turns of their own; rows with a null conv_id form one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: control strings of this template and of other common ones
CONTROL = r"(?:\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
ESCAPE = rf"([<\[])(?=~*{CONTROL})"
UNESCAPE = rf"([<\[])~(?=~*{CONTROL})"
START, PART, END = "<|start|>", "<|part|>", "<|end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit("$1~"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit("$1"))


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """Every backslash of an escaped role starts a pair."""
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def formatted(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", learn_role: str = ASSISTANT) -> DataFrame:
    """One row per conversation: conv id, `segments`, `formatted`."""
    rows = turns.select(F.col(f"`{conv_col}`").alias("_conv"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("_turn"))
    sorted_ = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))

    def pieces(turn: Column, i: Column) -> Column:
        goes_on = (i > 0) & (F.get("_turns", i - 1)["role"] == turn["role"])
        mark = F.when(goes_on, F.lit(PART)).otherwise(
            F.concat(F.when(i > 0, F.lit(f"{END}\n")).otherwise(F.lit("")), F.lit(START), escape_role(turn["role"]), F.lit("\n")))
        return F.array(F.struct(mark.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(turn["text"]).alias("text"), (turn["role"] == learn_role).alias("loss")))

    last = F.array(F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("_turns", pieces)), last)
    return sorted_.select("_conv", segments.alias("segments")).select(
        F.col("_conv").alias(conv_col), "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted_text: Column) -> Column:
    """The turns (role, text) a formatted text holds."""
    blocks = F.filter(F.split(formatted_text, r"\Q" + START + r"\E"), lambda _, i: i > 0)
    tail = len(END) + 1

    def turns(block: Column) -> Column:
        at = F.instr(block, "\n")
        body = block.substr(at + 1, F.char_length(block) - at - tail)
        role = unescape_role(block.substr(F.lit(1), at - 1))
        return F.transform(F.split(body, r"\Q" + PART + r"\E"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted output holds, read back from it: counts and digests of turns and of learned text."""
    turns = F.transform("_back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = chats.select(F.col(f"`{conv_col}`"), read_back(F.col("formatted")).alias("_back"),
                        loss_text(F.col("segments")).alias("_loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return back.select(
        F.col(f"`{conv_col}`"), F.size("_back").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars")
