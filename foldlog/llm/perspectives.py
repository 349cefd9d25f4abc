"""Perspective rotation: each dialogue once for every participant, that one as the assistant.

All built-in functions. A rendered dialogue is a run of rows, one per turn, not one string: a
dialogue of any length needs no task that holds it whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatFormat:
    """How a turn is written. ``context_roles`` speak to all and are nobody's perspective."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    context_roles: tuple[str, ...] = ("system",)
    unnamed: str = "unknown"


def speaker(role: Column, style: ChatFormat) -> Column:
    """The speaker's name: the role without surrounding blanks, ``unnamed`` where there is none."""
    name = F.trim(role)
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(style.unnamed)).otherwise(name)


def rotate_perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    style: ChatFormat = ChatFormat(),
) -> DataFrame:
    """One row for each turn and each participant of its conversation.

    ``perspective`` is the participant who is the assistant; ``role`` is ``assistant`` in the
    turns of that one, ``system`` in turns of a context role and ``user`` in all others, which carry
    the speaker's ``name``. ``rendered`` is the turn as it stands in the training text; the rows of
    one (conv_id, perspective) in the order of ``turn``, then ``name``, then ``rendered``, give the
    dialogue. ``mask_start`` and ``mask_end`` bound, in code points of ``rendered``, what is trained
    on: text and closing mark of the assistant's turns; they are equal, and empty, elsewhere.

    A dialogue of context turns only has no participant and no rows. Rows without conversation id
    belong to no dialogue. A null turn comes first, a null text counts as empty, a null or blank
    role is one speaker named ``unknown``. Repeated rows are repeated turns. Turns of equal number
    have the order given. Other columns are not read; an empty table gives no rows.

    The participants are found by a distinct with partial aggregation, then joined to the turns by
    the conversation: a conversation with much of all rows is split by adaptive execution.
    """
    own = turns.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        speaker(F.col(role_col).cast("string"), style).alias("name"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where(F.col("conv_id").isNotNull())
    context = F.col("name").isin(*style.context_roles) if style.context_roles else F.lit(False)
    people = own.where(~context).select("conv_id", F.col("name").alias("perspective")).distinct()
    mine = F.col("name") == F.col("perspective")
    role = F.when(mine, "assistant").when(context, "system").otherwise("user")
    head = F.concat(
        F.lit(style.opening),
        F.col("role"),
        F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(""),
        F.lit("\n"),
    )
    rendered = F.concat(F.col("head"), F.col("text"), F.lit(style.closing))
    trained = F.col("role") == "assistant"
    start = F.length("head").cast("bigint")
    return (
        own.join(people, "conv_id")
        .withColumn("role", role)
        .withColumn("head", head)
        .select(
            "conv_id",
            "perspective",
            "turn",
            "name",
            "role",
            rendered.alias("rendered"),
            start.alias("mask_start"),
            F.when(trained, F.length(rendered).cast("bigint")).otherwise(start).alias("mask_end"),
        )
    )


#: The same rows over the table ``conversations``.
PERSPECTIVES_SQL = """
WITH own AS (
  SELECT conv_id, turn,
         CASE WHEN coalesce(trim(role), '') = '' THEN 'unknown' ELSE trim(role) END AS name,
         coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
people AS (SELECT DISTINCT conv_id, name AS perspective FROM own WHERE name <> 'system'),
roles AS (
  SELECT *, CASE WHEN name = perspective THEN 'assistant'
                 WHEN name = 'system' THEN 'system' ELSE 'user' END AS role
  FROM own JOIN people USING (conv_id)),
heads AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || name ELSE '' END
            || chr(10) AS head
  FROM roles)
SELECT conv_id, perspective, turn, name, role,
       head || text || '<|im_end|>' || chr(10) AS rendered,
       length(head) AS mask_start,
       CASE WHEN role = 'assistant' THEN length(head || text || '<|im_end|>' || chr(10))
            ELSE length(head) END AS mask_end
FROM heads
"""
