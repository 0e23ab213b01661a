"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; runs of turns of one role merge into a
block. Output: ``<|role|>text<|turn|>text<|end|>`` per block. Inside roles and texts ``\\``, ``<`` and
``>`` are written ``\\bs;``, ``\\lt;`` and ``\\gt;``, so no text can hold a control string, and the
replacement is undone exactly. The loss mask is a list of code-point ranges of the output: the
assistant's texts.

Null text and null role are empty text. Turns sort by turn (null first), then role and text, so ties
and repeated rows have one result and every row is kept. Rows without a conv_id belong together with no
other: each is a conversation of one turn, so they make no hot group. An empty table gives no rows. Other
columns are ignored. A conversation is one output string and so is bounded by what a row can hold; it is
the only group. Time is linear in its length: places come from block-wise running sums, texts under the
mask from blocks of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import let, parts, sums_before

TURN, END = "<|turn|>", "<|end|>"


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\bs;"), ("<", "\\lt;"), (">", "\\gt;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in ((">", "\\gt;"), ("<", "\\lt;"), ("\\", "\\bs;")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted string, loss array<struct<s:int,e:int>> from rows (conv_id, turn, role, text)."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    keyed = turns.select("conv_id", alone.alias("alone"), row.alias("row"))
    grouped = keyed.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    coded = grouped.select("conv_id", F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"))

    def opened(x: Column) -> Column:
        """Each turn with what stands before it: the end of another role's block and its own mark, or the mark between turns of one role."""
        before = F.zip_with(x, F.slice(F.concat(F.array(F.lit(None).cast("string")), F.transform(x, lambda t: t["role"])), F.lit(1), F.size(x)), lambda t, last: F.struct(t.alias("t"), last.alias("last")))
        head = lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>"))
        mark = lambda z: F.when(z["last"].isNull(), head(z["t"])).when(z["last"] == z["t"]["role"], TURN).otherwise(F.concat(F.lit(END), head(z["t"])))
        return F.transform(before, lambda z: F.struct(z["t"]["role"].alias("role"), mark(z).alias("mark"), z["t"]["text"].alias("text")))

    # runs of one role merge: their texts stand in one block
    merged = coded.select("conv_id", let(F.col("turns"), opened).alias("turns"))

    def masked(x: Column) -> Column:
        """The assistant's texts, by running sums of the lengths before them."""
        sizes = F.transform(x, lambda t: F.length(t["mark"]) + F.length(t["text"]))
        places = F.zip_with(x, sums_before(sizes), lambda t, at: F.struct(t["role"].alias("role"), (at + F.length(t["mark"])).alias("s"), (at + F.length(t["mark"]) + F.length(t["text"])).alias("e")))
        return F.transform(F.filter(places, lambda p: p["role"] == "assistant"), lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e")))

    out = F.concat(F.array_join(F.transform("turns", lambda t: F.concat(t["mark"], t["text"])), ""), F.lit(END))
    return merged.select("conv_id", out.alias("formatted"), let(F.col("turns"), masked).alias("loss"))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """The inverse: conv_id, turns array<struct<role,text>>, loss_text, formatted."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda b: b != "")
    parsed = F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.regexp_extract(b, r"^<\|([^>]*)\|>", 1)).alias("role"),
            F.split(F.regexp_replace(b, r"^<\|[^>]*\|>", ""), r"<\|turn\|>", -1).alias("texts"),
        ),
    )
    turns = F.flatten(F.transform(parsed, lambda p: F.transform(p["texts"], lambda t: F.struct(p["role"].alias("role"), unescape(t).alias("text")))))
    loss = parts(F.col("formatted"), lambda part: F.array_join(F.transform("loss", lambda x: unescape(part(x["s"], x["e"]))), ""))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_text"))


def chats_digest(turns: DataFrame) -> DataFrame:
    """One row per conversation, all columns read back from the formatted string and its loss mask."""
    back = parse_chats(format_chats(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def control_conversation(turns: DataFrame) -> DataFrame:
    """Conversation -7: a user and an assistant who say what looks like control strings."""
    said = r"\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = turns.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)
