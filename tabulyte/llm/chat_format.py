"""Chat formatting in Spark expressions only.

A conversation is one string: `<|im_start|>role`, a line feed, the text and `<|im_end|>`
with a line feed per turn; adjacent turns of one role share a header and are parted by
`<|im_sep|>`.  Control strings inside roles and texts get a backslash after their first
character (one more where there are some already), which reading back takes away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Control strings that the template or common tokenizers give a meaning.
START, END, SEP, NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>", "<|im_nl|>"
#: What follows the first character of a control string.
_REST = r"/?s>|</?SYS>>|/?INST\]|\|(?:im_start|im_end|im_sep|im_nl|endoftext)\|>"
_PLAIN = rf"[<\[]\\*(?=(?:{_REST}))"
_ESCAPED = rf"([<\[]\\*)\\(?=(?:{_REST}))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def chat_format(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, and mask, the run lengths of
    formatted in code points, each with whether the loss counts them (texts of role
    `learn`, without headers, ends or separators).

    Turns are ordered by (turn, role, text), nulls first; ties and repeated rows all stay.
    A null role or text is an empty string; all turns of a null conversation id are one
    conversation.  An empty table gives no rows.  Columns not named are ignored.  A
    conversation is one output value, so its turns meet in one row."""
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    all_turns = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("turns"))

    def pieces(x: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        role = F.regexp_replace(escaped(x["role"]), "\n", NEWLINE)
        head = F.when(before.isNull() | (before != x["role"]), F.concat(F.lit(START), role, F.lit("\n"))).otherwise(F.lit(SEP))
        tail = F.when(after.isNull() | (after != x["role"]), F.lit(END)).otherwise(F.lit(""))
        return F.struct(head.alias("head"), escaped(x["text"]).alias("text"), tail.alias("tail"), (x["role"] == learn).alias("loss"))

    out = all_turns.select("conv_id", F.transform("turns", pieces).alias("p"))
    run = lambda text, loss: F.struct(F.length(text).alias("chars"), loss.alias("loss"))
    mask = F.flatten(F.transform("p", lambda p: F.array(run(p["head"], F.lit(False)), run(p["text"], p["loss"]), run(p["tail"], F.lit(False)))))
    text = F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["text"], p["tail"])), "")
    return out.select("conv_id", text.alias("formatted"), mask.alias("mask"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        body = F.substring(block, F.lit(len(START) + 1), F.length(block))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substring(body, F.length(role) + 2, F.length(body)), r"<\|im_sep\|>", -1)
        name = unescaped(F.regexp_replace(role, r"<\|im_nl\|>", "\n"))
        return F.transform(texts, lambda t: F.struct(name.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learnt_texts(formatted: str, mask: str) -> Column:
    """The texts that the loss counts, cut out of a formatted conversation by its mask, in order."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    step = lambda a, run: F.struct((a["at"] + run["chars"]).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts"))
    # four bytes a character, so that a cut costs its own length however far into the text it lies
    wide = F.encode(formatted, "UTF-32")
    runs = F.zip_with(mask, F.aggregate(mask, start, step)["starts"], lambda run, at: F.struct(run["chars"].alias("chars"), run["loss"].alias("loss"), at.alias("at")))
    piece = lambda run: F.substring(wide, run["at"] * 4 + 1, run["chars"] * 4)
    # a text may begin with a byte order mark, of which decoding takes one away
    text = lambda run: F.decode(F.concat(F.unhex(F.lit("0000FEFF")), piece(run)), "UTF-32")
    return F.transform(F.filter(runs, lambda run: run["loss"]), lambda run: unescaped(text(run)))
