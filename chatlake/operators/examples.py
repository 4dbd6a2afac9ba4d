"""Training and evaluation rows from conversations stored as one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import messages as M
from chatlake.functions.template import Template


def training_rows(
    conversations: DataFrame,
    template: Template,
    tools: Column | None = None,
    any_role: bool = False,
) -> DataFrame:
    """A row per trainable message of normalised ``messages``.

    Only model-written turns are used unless ``any_role`` lets every flagged
    turn in. Other columns are kept and nothing is shuffled.
    """
    kept = [c for c in conversations.columns if c != "messages"]
    positions = F.filter(
        F.transform(
            "messages",
            lambda m, i: F.when(
                m.getField("train_on_turn")
                & (F.lit(any_role) | M.is_reply(m.getField("role"))),
                i,
            ),
        ),
        lambda i: i.isNotNull(),
    )
    texts = F.transform(template.turns(F.col("messages"), tools), lambda t: t.getField("text"))
    picked = conversations.select(
        *kept, texts.alias("_texts"), positions.alias("_positions")
    ).select(*kept, "_texts", F.explode("_positions").alias("turn_index"))
    return picked.select(
        *kept,
        "turn_index",
        F.array_join(F.slice("_texts", F.lit(1), F.col("turn_index")), "").alias("prompt"),
        F.try_element_at("_texts", F.col("turn_index") + 1).alias("completion"),
    ).withColumn("text", F.concat("prompt", "completion"))


def evaluation_rows(
    conversations: DataFrame, template: Template, tools: Column | None = None
) -> DataFrame:
    """An evaluation example per conversation with a reply: the messages before
    the last reply as prompt, that reply as expected text and tool call. Later
    messages are ignored. Other columns are kept."""
    kept = [c for c in conversations.columns if c != "messages"]
    located = conversations.withColumn("_last", M.last_reply_index(F.col("messages"))).filter(
        F.col("_last").isNotNull()
    )
    reply = F.try_element_at("messages", F.col("_last") + 1)
    return located.select(
        *kept,
        template.prompt(M.history(F.col("messages"), F.col("_last")), tools).alias("prompt"),
        reply.getField("content").alias("expected_text"),
        F.try_element_at(reply.getField("tool_calls"), F.lit(1)).alias("expected_tool"),
    )
