"""Chat formatting by array expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role are merged into one
block; the blocks are concatenated. Control strings inside texts and roles are escaped, so the output can be
read back (``parse``) and no text can open or close a block::

    <|turn|>ROLE<|text|>TEXT<|more|>TEXT<|end|>

``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|``. The loss mask is run-length coded: for every
assistant text the number of code points to skip since the last one, and its own length.

Defined cases: null text or role counts as empty; null turns come first; rows of equal turn are ordered by
role and text; repeated rows are turns of their own; a null conversation id is a conversation of its own;
columns beside the four are left behind; an empty table gives no rows. A conversation becomes one row, so it has to fit into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def format_chats(conversations: DataFrame, learn: str = ASSISTANT) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_runs`` (array of ``skip``, ``take``): texts of role ``learn`` are learned."""
    turns = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("turn"),
    )
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    # A turn whose predecessor has another role opens a block; each block takes the turns up to the next one.
    opens = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    chats = chats.withColumn("opens", opens)
    blocks = F.transform(
        "opens",
        lambda start, k: F.struct(
            F.get("turns", start)["role"].alias("role"),
            F.transform(
                F.slice("turns", start + 1, F.coalesce(F.get("opens", k + 1), F.size("turns")) - start),
                lambda t: escaped(t["text"]),
            ).alias("texts"),
        ),
    )
    chats = chats.select("conv_id", blocks.alias("blocks"))

    def block_text(b: Column) -> Column:
        return F.concat(
            F.lit(TURN), escaped(b["role"]), F.lit(TEXT), F.array_join(b["texts"], MORE), F.lit(END)
        )

    # Pieces of the output in order: how many code points of marks come before each text, and how many it has.
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b, n: F.transform(
                b["texts"],
                lambda t, k: F.struct(
                    F.when(
                        k == 0,
                        F.when(n == 0, 0).otherwise(len(END))
                        + len(TURN)
                        + F.char_length(escaped(b["role"]))
                        + len(TEXT),
                    )
                    .otherwise(len(MORE))
                    .cast("long")
                    .alias("before"),
                    F.char_length(t).cast("long").alias("size"),
                    (b["role"] == learn).alias("learned"),
                ),
            ),
        )
    )
    state = "struct<skip:bigint,runs:array<struct<skip:bigint,take:bigint>>>"
    runs = F.aggregate(
        pieces,
        F.from_json(F.lit('{"skip":0,"runs":[]}'), state),
        lambda acc, p: F.when(
            p["learned"],
            F.struct(
                F.lit(0).cast("long").alias("skip"),
                F.concat(
                    acc["runs"],
                    F.array(F.struct((acc["skip"] + p["before"]).alias("skip"), p["size"].alias("take"))),
                ).alias("runs"),
            ),
        ).otherwise(
            F.struct((acc["skip"] + p["before"] + p["size"]).alias("skip"), acc["runs"].alias("runs"))
        ),
        lambda acc: acc["runs"],
    )
    formatted = F.array_join(F.transform("blocks", block_text), "")
    return chats.select("conv_id", formatted.alias("formatted"), runs.alias("loss_runs"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``role`` and ``text``."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring_index(b, TEXT, -1), r"<\|more\|>"),
                lambda t: F.struct(
                    unescaped(
                        F.substr(
                            F.substring_index(b, TEXT, 1),
                            F.lit(len(TURN) + 1),
                        )
                    ).alias("role"),
                    unescaped(t).alias("text"),
                ),
            ),
        )
    )


def masked(formatted: Column, runs: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    state = "struct<at:bigint,texts:array<string>>"
    return F.aggregate(
        runs,
        F.from_json(F.lit('{"at":0,"texts":[]}'), state),
        lambda acc, r: F.struct(
            (acc["at"] + r["skip"] + r["take"]).alias("at"),
            F.concat(
                acc["texts"],
                F.array(
                    unescaped(
                        F.substr(
                            formatted,
                            (acc["at"] + r["skip"] + 1).cast("int"),
                            r["take"].cast("int"),
                        )
                    )
                ),
            ).alias("texts"),
        ),
        lambda acc: acc["texts"],
    )
