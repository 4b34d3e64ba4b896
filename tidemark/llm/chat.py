r"""Conversations as training text, with a loss mask, by Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role are merged by
array functions; marks and texts are then concatenated. The template, for every run of turns of one role:

    [INST] role [/INST]text<s>text</s>

``<s>`` stands between the texts of turns that were merged, so no turn is lost. Control strings in a role or
a text are made harmless by a backslash after their bracket, and one that already has backslashes gets
one more: ``</s>`` becomes ``<\/s>`` and ``<\/s>`` becomes ``<\\/s>``. So no text holds a mark, and taking one
backslash away gives back exactly what was there.

The loss mask is an array with one flag per stretch of the output between control strings, in order: true for
a text of the assistant. A stretch is found by splitting the output at its control strings.

Defined results: a null role or text is empty. Turns are sorted by turn, then role, then text, by their bytes;
a null turn comes first; repeated rows are turns of their own. Rows without a conversation key are one
conversation with a null key. Other columns are ignored. An empty table gives no rows. A conversation is one
row of the result, so it is one value in one task, and 2 GB of text at most, as any Spark string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
# The marks of the template, which are fixed values.
ROLE_BEGINS, ROLE_ENDS, NEXT_TEXT, TURN_ENDS = "[INST] ", " [/INST]", "<s>", "</s>"
_MARKS = r"\[INST\] | \[/INST\]|</?s>"
_CONTROL = r"([<\[])(\\*+)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*+)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """The text without control strings."""
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    """What :func:`escape` was given."""
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit(r"$1$2$3"))


def format_chats(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask) of every conversation, from rows with conv_id, turn, role, text."""
    plain = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = plain.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # Where a run of turns of one role begins; the end of the last run closes the list.
    begins = F.expr(
        "array_append(filter(sequence(0, size(turns) - 1), i -> i = 0 OR turns[i].role <> turns[i - 1].role), size(turns))"
    )
    # Both steps end in a generated row: the arrays are then columns, computed once, not copied into each lambda.
    indexed = turns.select("conv_id", "turns", F.inline(F.array(F.struct(begins.alias("begins")))))
    run = F.expr(
        "transform(slice(begins, 1, size(begins) - 1), (b, k) -> "
        "named_struct('role', turns[b].role, 'texts', transform(slice(turns, b + 1, begins[k + 1] - b), t -> t.text)))"
    )
    merged = indexed.select("conv_id", F.inline(F.array(F.struct(run.alias("runs")))))

    def written(run: Column) -> Column:
        texts = F.transform(run["texts"], escape)
        return F.concat(
            F.lit(ROLE_BEGINS), escape(run["role"]), F.lit(ROLE_ENDS), F.array_join(texts, NEXT_TEXT), F.lit(TURN_ENDS)
        )

    def flags(run: Column) -> Column:
        # Before the role, the role, then a flag per text.
        texts = F.transform(run["texts"], lambda _: run["role"] == ASSISTANT)
        return F.concat(F.array(F.lit(False), F.lit(False)), texts)

    mask = F.concat(F.flatten(F.transform("runs", flags)), F.array(F.lit(False)))
    return merged.select(
        "conv_id", F.array_join(F.transform("runs", written), "").alias("formatted"), mask.alias("loss_mask")
    )


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) from what :func:`format_chats` wrote and from nothing else.

    ``turns`` is an array of (role, text); ``loss_text`` is what the mask covers, each text unescaped.
    """
    stretches = F.split("formatted", _MARKS, -1)
    cut = chats.select("conv_id", "loss_mask", F.char_length("formatted").cast("long").alias("formatted_chars"),
                       F.split("formatted", TURN_ENDS, -1).alias("runs"),
                       F.inline(F.array(F.struct(stretches.alias("stretches")))))
    learned = F.expr("transform(filter(arrays_zip(stretches, loss_mask), s -> s.loss_mask), s -> s.stretches)")

    def turns_of(run: Column) -> Column:
        sides = F.split(run, r" \[/INST\]", 2)
        role = unescape(F.substring(sides[0], len(ROLE_BEGINS) + 1, 2**31 - 1))
        return F.transform(F.split(sides[1], NEXT_TEXT, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return cut.select(
        "conv_id",
        F.flatten(F.transform(F.expr("slice(runs, 1, size(runs) - 1)"), turns_of)).alias("turns"),
        F.array_join(F.transform(learned, unescape), "").alias("loss_text"),
        "formatted_chars",
    )


def digests(chats: DataFrame) -> DataFrame:
    """Counts and hashes of what is read back from formatted conversations."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(chats).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_hostile_example(rows: DataFrame) -> DataFrame:
    """The rows of conversations, and conversation -7, whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = F.inline(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(said).alias("text"))
        for turn, role in enumerate(("user", ASSISTANT))
    ]))
    example = rows.sparkSession.range(1).select(turns)
    return rows.select("conv_id", "turn", "role", "text").unionByName(example)
