"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, merged where neighbours share a role,
and concatenated. The template::

    <s>[INST]user[TEXT]first[NEXT]second[/INST][ANS]assistant[TEXT]answer</s>

``[ANS] .. </s>`` holds the turns of the roles that bear loss, ``[INST] .. [/INST]`` all others; ``[NEXT]``
parts turns merged into one block. A control string inside a text or role gets a backslash after its
first character, and one that already has backslashes there gets one more, so that no text can forge a mark
and unescaping is exact.

Defined results: null text and null role are empty; turns of equal number are ordered by role, then
text; a null number comes first; repeated rows are repeated turns; an empty table gives no rows. Rows of a conversation are
collected into one string, which is what the operator makes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLES = ("assistant",)

# fixed values of the template
OPEN, CLOSE, OPEN_LOSS, CLOSE_LOSS, TEXT, NEXT, BEGIN = "[INST]", "[/INST]", "[ANS]", "</s>", "[TEXT]", "[NEXT]", "<s>"
_TAIL = r"(/?s>|/?INST\]|ANS\]|TEXT\]|NEXT\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss_spans) from rows (conv_id, turn, role, text).

    ``loss_spans`` are [start, end) in code points of ``formatted``, one for each turn
    that bears loss, in order; marks and roles are outside.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")

    def block_at(i: Column, k: Column) -> Column:
        """The block that starts at turn i, the k-th change of role, and ends before the next one."""
        end = F.coalesce(F.get("changes", k + 1), n)
        texts = F.transform(F.slice("turns", i + 1, end - i), lambda t: escape(t["text"]))
        role = F.element_at("turns", i + 1)["role"]
        return F.struct(role.alias("role"), texts.alias("texts"))

    first_of_block = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    blocks = sorted_turns.withColumn("changes", first_of_block).withColumn("blocks", F.transform("changes", block_at))

    def bears_loss(block: Column) -> Column:
        return block["role"].isin(*loss_roles)

    def head(block: Column) -> Column:
        return F.concat(
            F.when(bears_loss(block), F.lit(OPEN_LOSS)).otherwise(F.lit(OPEN)), escape(block["role"]), F.lit(TEXT)
        )

    def tail(block: Column) -> Column:
        return F.when(bears_loss(block), F.lit(CLOSE_LOSS)).otherwise(F.lit(CLOSE))

    def whole(block: Column) -> Column:
        return F.concat(head(block), F.array_join(block["texts"], NEXT), tail(block))

    rendered = blocks.withColumn("rendered", F.transform("blocks", whole))
    # where each block starts: running sums of the lengths, built once per conversation
    starts = F.aggregate(
        "rendered",
        F.array(F.lit(len(BEGIN)).cast("long")),
        lambda sums, r: F.concat(sums, F.array(F.element_at(sums, -1) + F.length(r))),
    )

    def spans_of(block: Column, start: Column) -> Column:
        first = start + F.length(head(block))
        ends = F.aggregate(
            block["texts"],
            F.array(first - len(NEXT)),
            lambda done, t: F.concat(done, F.array(F.element_at(done, -1) + len(NEXT) + F.length(t))),
        )
        return F.transform(
            block["texts"],
            lambda t, i: F.struct(
                (F.get(ends, i + 1) - F.length(t)).alias("start"), F.get(ends, i + 1).alias("end")
            ),
        )

    none = F.slice(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), 1, 0)
    with_starts = rendered.withColumn("starts", starts)
    spans = F.flatten(
        F.transform("blocks", lambda b, i: F.when(bears_loss(b), spans_of(b, F.get("starts", i))).otherwise(none))
    )
    return with_starts.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join("rendered", "")).alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unmerged and unescaped."""
    body = F.substring(formatted, len(BEGIN) + 1, F.length(formatted))
    blocks = F.filter(F.split(body, r"\[/INST\]|</s>"), lambda b: F.length(b) > 0)

    def turns(block: Column) -> Column:
        parts = F.split(F.regexp_replace(block, r"^\[(INST|ANS)\]", ""), r"\[TEXT\]")
        role = unescape(F.get(parts, F.lit(0)))
        return F.transform(
            F.split(F.get(parts, F.lit(1)), r"\[NEXT\]"),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined without anything between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )
