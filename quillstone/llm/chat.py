"""Chat formatting with prefix-target expansion. DataFrame functions only.

A conversation is rendered once: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Each assistant
turn is an example of its own: its context is all that stands before the reply, its target the reply.
``expand`` makes them rows. Since every context is a prefix of the one rendering, a row has its reply and the
length of its context, and a conversation's first row the rendering; storing all prefixes would grow with the
square of a conversation. ``with_context`` cuts the contexts out, for a reader that wants strings.

Inside texts and roles each ``<|`` becomes ``<||``, so neither marker can occur there, and the way back
is to turn ``<||`` into ``<|``. In roles a backslash and a line feed are escaped too.

Defined results: turns are ordered by turn, then role, then text, nulls first. A null role or text is
empty. Only the role ``assistant`` is trainable. Rows without conv_id form one conversation. Repeated
rows are turns of their own. A conversation without an assistant turn has no example, but a row with its
rendering. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The markers of the template.
START, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """The way back: pairs of backslashes part first, so that they don't meet a following n."""
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, rendered, examples): examples hold (example, context_chars, target_chars)."""
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    ordered = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    body = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("text"),
            (t["role"] == REPLY).alias("reply"),
        ),
    )
    parts = ordered.select("conv_id", body.alias("body"))
    rendered = F.array_join(F.transform("body", lambda t: F.concat(t["head"], t["text"], F.lit(END + "\n"))), "")
    # Lengths run over an array of numbers that is as long as the conversation, never over its text.
    sizes = F.transform("body", lambda t: F.struct(F.char_length(t["head"]).cast("long").alias("head"), F.char_length(t["text"]).cast("long").alias("text"), t["reply"].alias("reply")))
    return (
        parts.select("conv_id", rendered.alias("rendered"), sizes.alias("sizes"))
        .select("conv_id", "rendered", "sizes", _running("sizes").alias("ends"))
        .select(
            "conv_id",
            "rendered",
            F.filter(
                F.transform(
                    F.arrays_zip("sizes", "ends"),
                    lambda z: F.struct((z["ends"] - z["sizes"]["text"] - len(END) - 1).alias("context_chars"), z["sizes"]["text"].alias("target_chars"), z["sizes"]["reply"].alias("reply")),
                ),
                lambda e: e["reply"],
            ).alias("found"),
        )
        .select("conv_id", "rendered", F.transform("found", lambda e, i: F.struct((i + 1).alias("example"), e["context_chars"], e["target_chars"])).alias("examples"))
    )


def _running(sizes: str) -> Column:
    """Where each turn ends in the rendering: sums of blocks of 64 turns first, then within a block."""
    tail = len(END) + 1
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, t: a + t["head"] + t["text"] + tail)
    blocks = F.transform(F.expr(f"sequence(0, (size({sizes}) - 1) div 64)"), lambda b: F.slice(sizes, (b * 64 + 1).cast("int"), F.lit(64)))
    before = F.aggregate(F.transform(blocks, total), F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("part"), F.slice(before, F.lit(1), F.size(blocks)).alias("from")),
            lambda z: F.transform(F.sequence(F.lit(1), F.size(z["part"])), lambda i: z["from"] + total(F.slice(z["part"], F.lit(1), i))),
        )
    )


def expand(formatted: DataFrame) -> DataFrame:
    """(conv_id, example, context_chars, target, rendered): one row for each assistant turn; only target is trainable.

    The context is the first context_chars of the conversation's rendering, which its first row holds.
    """
    cut = lambda e: F.substring("rendered", (e["context_chars"] + 1).cast("int"), e["target_chars"].cast("int"))
    examples = F.transform("examples", lambda e: F.named_struct(F.lit("example"), e["example"], F.lit("context_chars"), e["context_chars"], F.lit("target"), cut(e)))
    rows = formatted.select("conv_id", "rendered", F.explode_outer(examples).alias("e"))
    return rows.select("conv_id", "e.*", F.when(F.coalesce("e.example", F.lit(1)) == 1, F.col("rendered")).alias("rendered"))


def with_context(examples: DataFrame) -> DataFrame:
    """(conv_id, example, context, target) of the rows of ``expand``, the contexts as strings."""
    whole = examples.where(F.col("rendered").isNotNull()).select(F.col("conv_id").alias("r_conv"), F.col("rendered").alias("whole"))
    rows = examples.where(F.col("example").isNotNull()).join(whole, F.col("conv_id").eqNullSafe(F.col("r_conv")))
    return rows.select("conv_id", "example", F.substring("whole", F.lit(1), F.col("context_chars").cast("int")).alias("context"), "target")


def read_turns(rendered: Column) -> Column:
    """The turns (role, text) back from a rendering."""
    return F.transform(
        F.filter(F.split(rendered, r"<\|im_start\|>", -1), lambda x: x != ""),
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substring(x, F.position(F.lit("\n"), x) + 1, F.char_length(x) - F.position(F.lit("\n"), x) - len(END) - 1)).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the rows of ``expand`` alone.

    The loss is what the examples' targets say, in order. Rows of a conversation are together since they were
    made, so this needs no shuffle.
    """
    target = F.when(F.col("example").isNotNull(), F.struct("example", "target"))
    whole = examples.groupBy("conv_id").agg(F.max("rendered").alias("rendered"), F.sort_array(F.collect_list(target)).alias("targets"))
    read = whole.select("conv_id", "rendered", read_turns(F.col("rendered")).alias("turns"), F.array_join(F.transform("targets", lambda e: unescape(e["target"])), "").alias("loss"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("rendered").cast("long").alias("formatted_chars"),
    )
