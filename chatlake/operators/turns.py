"""Conversations stored as one row per turn.

Turns are grouped into blocks of bounded length, sorted inside each block. A
conversation of ordinary length is exactly one block. A very long one spans
several, which are processed by different tasks; the text before each block is
then built by doubling: after k joins on the unique key (conversation, block) a
block knows the text of the 2^k blocks up to it.

Turns without a position, and with a negative one, stand before all others, in
the first block. A null conversation is a conversation like any other: the
conversation is a struct while rows are grouped and joined, which is never null.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions.messages import is_reply, role_problem
from chatlake.functions.template import CHATML, Template
from chatlake.operators.ordering import assign_split, index_by_key
from chatlake.session import checkpointed, lookup

# Turns collected into one array at most.
BLOCK_TURNS = 512


@dataclass(frozen=True)
class TurnColumns:
    """Names of the columns of a turn table. ``turn`` is a 0-based position,
    unique in a conversation."""

    conversation: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"

    def key(self) -> Column:
        return F.struct(F.col(self.conversation).alias("conversation")).alias("_key")

    def value_of(self, key: str) -> Column:
        return F.col(key).getField("conversation").alias(self.conversation)


@dataclass(frozen=True)
class TurnBlocks:
    """Blocks of turns: ``rows`` has ``_key`` (a struct with the conversation),
    ``_block`` and the sorted array ``turns``; ``count`` is the number of blocks
    of the longest conversation, and ``long`` the conversations of several
    blocks with their ``_last_block``."""

    rows: DataFrame
    count: int
    columns: TurnColumns
    long: DataFrame

    @property
    def keys(self) -> list[str]:
        return ["_key", "_block"]

    @property
    def conversation(self) -> Column:
        return self.columns.value_of("_key")


def block_count(turns: DataFrame, columns: TurnColumns, block_turns: int) -> int:
    """Blocks of the longest conversation. Only turns beyond the first block
    are read, which Parquet statistics skip when there are none."""
    turn = F.col(columns.turn)
    longest = turns.filter(turn >= block_turns).agg(F.max(turn)).first()[0]
    return 1 if longest is None else int(longest) // block_turns + 1


def _block_of(turn: str, block_turns: int) -> Column:
    return F.greatest(F.lit(0), F.floor(F.col(turn) / block_turns)).cast("long")


def turn_blocks(
    turns: DataFrame,
    fields: dict[str, Column],
    columns: TurnColumns = TurnColumns(),
    block_turns: int = BLOCK_TURNS,
) -> TurnBlocks:
    """Collect ``fields`` of the turns into sorted arrays, one per block."""
    count = block_count(turns, columns, block_turns)
    entry = F.struct(
        F.col(columns.turn).alias("turn"), *[value.alias(name) for name, value in fields.items()]
    )
    collected = F.array_sort(F.collect_list("_entry")).alias("turns")
    entries = turns.select(columns.key(), F.col(columns.turn).alias("_turn"), entry.alias("_entry"))
    if count == 1:
        grouped = entries.groupBy("_key").agg(collected).withColumn("_block", F.lit(0).cast("long"))
    else:
        grouped = entries.groupBy("_key", _block_of("_turn", block_turns).alias("_block")).agg(collected)
    long = (
        turns.filter(F.col(columns.turn) >= block_turns)
        .groupBy(columns.key())
        .agg(F.floor(F.max(columns.turn) / block_turns).cast("long").alias("_last_block"))
    )
    return TurnBlocks(grouped, count, columns, long)


def assemble(
    turns: DataFrame, columns: TurnColumns = TurnColumns(), extra: dict[str, Column] | None = None
) -> DataFrame:
    """One row per conversation with its ordered ``messages``.

    This is the layout of a message dataset, where a conversation is a row. The
    operators on turns below do not need it.
    """
    fields = {"role": F.col(columns.role), "content": F.col(columns.text), **(extra or {})}
    blocks = turn_blocks(turns, fields, columns)
    rows = blocks.rows
    if blocks.count > 1:
        rows = rows.groupBy("_key").agg(
            F.array_sort(F.collect_list(F.struct("_block", "turns"))).alias("_blocks")
        ).select("_key", F.flatten(F.col("_blocks.turns")).alias("turns"))
    messages = F.transform(
        "turns", lambda t: F.struct(*[t.getField(name).alias(name) for name in fields])
    )
    return rows.select(blocks.conversation, messages.alias("messages"))


def rendered_blocks(
    turns: DataFrame,
    trainable: Column,
    template: Template = CHATML,
    columns: TurnColumns = TurnColumns(),
    block_turns: int = BLOCK_TURNS,
) -> TurnBlocks:
    """Blocks of rendered turns of valid conversations. Each turn is rendered in
    its own row before the shuffle, so only its text and flags are grouped."""
    role = F.col(columns.role)
    fields = {
        "text": template.turn(role, F.coalesce(F.col(columns.text), F.lit(""))),
        "trainable": F.coalesce(trainable, F.lit(False)),
        "reply": is_reply(role),
        "valid": role_problem(role, F.coalesce(F.col(columns.turn), F.lit(0))).isNull(),
    }
    blocks = turn_blocks(turns, fields, columns, block_turns)
    if blocks.count == 1:
        valid = blocks.rows.filter(F.forall("turns", lambda t: t.getField("valid")))
    else:
        invalid = lookup(checkpointed(invalid_conversations(turns, columns).select(columns.key())))
        valid = blocks.rows.join(invalid, "_key", "left_anti")
    return replace(blocks, rows=valid)


def render_turns(
    turns: DataFrame, template: Template = CHATML, columns: TurnColumns = TurnColumns()
) -> DataFrame:
    """Rendered text of every turn, without any shuffle."""
    role = F.col(columns.role)
    text = template.turn(role, F.coalesce(F.col(columns.text), F.lit("")))
    return turns.select(columns.conversation, columns.turn, text.alias("turn_text"))


def with_text_before(blocks: TurnBlocks) -> DataFrame:
    """Add ``_before``, the text of all earlier blocks of the conversation."""
    rows = blocks.rows
    if blocks.count == 1:
        return rows.withColumn("_before", F.lit(""))
    # one row per block of the long conversations, also for blocks without turns
    slots = blocks.long.select(
        "_key", F.explode(F.sequence(F.lit(0).cast("long"), "_last_block")).alias("_block")
    )
    texts = slots.join(
        rows.select(*blocks.keys, F.array_join(F.col("turns.text"), "").alias("_text")),
        blocks.keys,
        "left",
    )
    reach = 1
    while reach < blocks.count - 1:
        # each round reads the texts twice, so they are cut from their lineage
        texts = checkpointed(texts)
        earlier = texts.select(
            "_key", (F.col("_block") + reach).alias("_block"), F.col("_text").alias("_earlier")
        )
        texts = texts.join(earlier, blocks.keys, "left").select(
            *blocks.keys,
            F.concat(F.coalesce("_earlier", F.lit("")), F.coalesce("_text", F.lit(""))).alias("_text"),
        )
        reach *= 2
    before = texts.select(
        "_key", (F.col("_block") + 1).alias("_block"), F.col("_text").alias("_before")
    )
    return rows.join(before, blocks.keys, "left").withColumn(
        "_before", F.coalesce("_before", F.lit(""))
    )


def with_conversation_columns(blocks: TurnBlocks, values: DataFrame) -> TurnBlocks:
    """Attach columns of a frame with one row per conversation.

    The values of a long conversation are repeated for each of its blocks, so
    the join runs on the key the blocks are spread by already and no
    conversation ends up in one task.
    """
    keyed = values.withColumn("_key", blocks.columns.key()).drop(blocks.columns.conversation)
    if blocks.count == 1:
        return replace(blocks, rows=blocks.rows.join(keyed, "_key"))
    slots = F.sequence(F.lit(0).cast("long"), F.coalesce("_last_block", F.lit(0).cast("long")))
    spread = keyed.join(blocks.long, "_key", "left").withColumn("_block", F.explode(slots))
    return replace(blocks, rows=blocks.rows.join(spread.drop("_last_block"), blocks.keys))


def training_rows(blocks: TurnBlocks) -> DataFrame:
    """A row per trainable turn: everything before it, the turn, and both.

    Columns attached to the conversations are kept.
    """
    extra = [c for c in blocks.rows.columns if c not in ("_key", "_block", "turns")]
    positions = F.filter(
        F.transform("turns", lambda t, i: F.when(t.getField("trainable"), i)), lambda i: i.isNotNull()
    )
    picked = with_text_before(blocks).select(
        "_key", *extra, "_before", "turns", F.explode(positions).alias("_at")
    )
    turn = F.try_element_at("turns", F.col("_at") + 1)
    context = F.array_join(F.slice(F.col("turns.text"), F.lit(1), F.col("_at")), "")
    return picked.select(
        blocks.conversation,
        *extra,
        turn.getField("turn").cast("int").alias("turn_index"),
        F.concat("_before", context).alias("prompt"),
        turn.getField("text").alias("completion"),
    ).withColumn("text", F.concat("prompt", "completion"))


def split_training_rows(
    turns: DataFrame,
    trainable: Column,
    template: Template = CHATML,
    columns: TurnColumns = TurnColumns(),
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """Training rows with the index of their conversation and the split.

    Only the conversation ids are ranked; they then join the blocks, which are
    spread by conversation already, before the texts fan out.
    """
    index = index_by_key(turns.select(columns.conversation).distinct(), [columns.conversation])
    blocks = rendered_blocks(turns, trainable, template, columns, block_turns)
    return training_rows(with_conversation_columns(blocks, assign_split(index)))


def split_counts(
    turns: DataFrame, trainable: Column, columns: TurnColumns = TurnColumns()
) -> DataFrame:
    """Training rows per split, as ``split_training_rows`` would make them. Texts are
    neither read nor rendered: a conversation sends its number of trainable
    turns and whether it is valid."""
    counted = turns.groupBy(columns.conversation).agg(
        F.count_if(F.coalesce(trainable, F.lit(False))).alias("_rows"),
        F.bool_and(role_problem(F.col(columns.role), F.coalesce(F.col(columns.turn), F.lit(0))).isNull()).alias("_valid"),
    )
    indexed = assign_split(index_by_key(counted, [columns.conversation]))
    made = indexed.filter(F.col("_valid") & (F.col("_rows") > 0))
    return made.groupBy("split").agg(F.sum("_rows").alias("examples"))


def evaluation_prompts(
    blocks: TurnBlocks, template: Template = CHATML
) -> DataFrame:
    """Prompt of each conversation: the turns before its last reply and the
    start of a reply. Conversations without a reply give no row.

    The block of the last reply is found from the flags; the text of the blocks
    before it is then put together once, not for every block.
    """
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t.getField("reply"), i)))
    rows = blocks.rows.withColumn("_last", last)
    if blocks.count == 1:
        rows = rows.filter(F.col("_last").isNotNull()).withColumn("_before", F.lit(""))
    else:
        final = rows.filter(F.col("_last").isNotNull()).groupBy("_key").agg(F.max("_block").alias("_final"))
        final = final.join(blocks.long.select("_key"), "_key", "left_semi")
        final = lookup(checkpointed(final))
        placed = rows.join(final, "_key", "left")
        short = placed.filter(F.col("_final").isNull() & F.col("_last").isNotNull()).withColumn("_before", F.lit(""))
        text = F.array_join(F.col("turns.text"), "")
        before = placed.filter(F.col("_block") < F.col("_final")).groupBy("_key").agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_block", text.alias("text")))), lambda b: b["text"]), ""
            ).alias("_before")
        )
        ends = placed.filter(F.col("_block") == F.col("_final")).drop("_final").join(before, "_key", "left")
        rows = short.drop("_final").unionByName(ends.withColumn("_before", F.coalesce("_before", F.lit(""))))
    context = F.array_join(F.slice(F.col("turns.text"), F.lit(1), F.col("_last")), "")
    return rows.select(
        blocks.conversation,
        F.try_element_at("turns", F.col("_last") + 1).getField("turn").alias("reply_turn"),
        F.concat("_before", context, F.lit(template.generation)).alias("prompt"),
    )


def invalid_conversations(
    turns: DataFrame, columns: TurnColumns = TurnColumns()
) -> DataFrame:
    """Conversations with an unacceptable role, and the first reason. Only the
    offending turns are aggregated."""
    problem = role_problem(F.col(columns.role), F.coalesce(F.col(columns.turn), F.lit(0)))
    return (
        turns.select(columns.conversation, F.col(columns.turn).alias("_turn"), problem.alias("_problem"))
        .filter(F.col("_problem").isNotNull())
        .groupBy(columns.conversation)
        .agg(F.min(F.struct("_turn", "_problem")).getField("_problem").alias("reason"))
    )
