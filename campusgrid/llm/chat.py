"""Chat formatting with rotating perspectives, in DataFrame operations only.

Every participant of a conversation becomes the assistant once: their turns are
written as the assistant's and are the ones to train on, those of all others as
named users'. System turns stay system turns for everyone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.llm.common import written

START, END = "<|im_start|>", "<|im_end|>"
#: Turns in one part at most. A longer conversation is rendered in several rows, so that
#: no task has to hold one of any length.
PART_TURNS = 2048
UNKNOWN = "unknown"


def _plain(text: Column) -> Column:
    """Text that cannot be taken for a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.join(right.select(F.col("conv_id").alias("_c")), F.col("conv_id").eqNullSafe(F.col("_c")), how)


def _crowded(rows: DataFrame, part_turns: int) -> DataFrame:
    """Conversations with a part of more than `part_turns` rows."""
    counted = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    return written(counted.filter(F.col("n") > part_turns).select("conv_id").distinct())


def _numbered(rows: DataFrame, part_turns: int) -> DataFrame:
    """The distinct rows, with parts of `part_turns` rows counted in order.

    Rows are sorted by ranges, so that one conversation is dealt over many tasks; the
    counts per range, summed up, give the first number in each.
    """
    order = ("conv_id", "unnumbered", "turn", "role", "text")
    marked = rows.withColumn("unnumbered", (F.col("part") == -1) & (F.col("turn") == 0)).drop("part")
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("slot", F.shiftright("at", 33))
    slots = placed.groupBy("conv_id", "unnumbered", "slot").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "unnumbered").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select(
        F.col("conv_id").alias("_c"),
        F.col("unnumbered").alias("_u"),
        F.col("slot").alias("_s"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    own = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("unnumbered") == F.col("_u")) & (F.col("slot") == F.col("_s"))
    part = F.floor((F.col("at") + F.col("shift")) / part_turns)
    part = F.when(F.col("unnumbered"), -1 - part).otherwise(part).cast("bigint")
    return placed.join(slots, own).select("conv_id", part.alias("part"), "turn", "role", "text")


def _in_parts(rows: DataFrame, part_turns: int) -> DataFrame:
    """The rows, with other parts where a conversation has too many rows in one."""
    crowded = _crowded(rows, part_turns)
    if crowded.isEmpty():
        return rows
    distinct = written(_same(rows, crowded, "left_semi").distinct())
    crowded = _crowded(distinct, part_turns)
    if crowded.isEmpty():
        return rows
    return _same(rows, crowded, "left_anti").unionByName(_numbered(_same(distinct, crowded, "left_semi"), part_turns))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """One row per conversation, part and speaker: `text` rendered with the speaker as
    assistant, `trained`: code points from-to of the speaker's words and end markers,
    comma-separated, n_turns and n_trained turns.

    Turns are ordered by turn, role and text; a repeated row counts once. A null role
    is the speaker `unknown`, a null text is empty, turns without a number come last in
    a part of their own (-1), rows without conv_id form one conversation. A
    conversation with system turns only has no speaker and no row. Other columns are
    ignored.

    A part holds the turn numbers from part * `part_turns` on. Where that would be more
    than `part_turns` rows (turn numbers repeat or are null), the parts of the whole
    conversation hold `part_turns` rows each: 0, 1, 2... in order, then -1, -2, -3...
    for turns without a number.
    """
    role = F.regexp_replace(_plain(F.coalesce("role", F.lit(UNKNOWN))), r"\s", "_")
    rows = turns.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("bigint").alias("part"),
        F.coalesce("turn", F.lit(0)).cast("bigint").alias("turn"),
        role.alias("role"),
        _plain(F.col("text")).alias("text"),
    )
    rows = _in_parts(rows, part_turns)
    parts = rows.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns")
    )
    speakers = rows.filter("role <> 'system'").select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def head(t: Column) -> Column:
        name = (
            F.when(t["role"] == F.col("speaker"), "assistant")
            .when(t["role"] == "system", "system")
            .otherwise(F.concat(F.lit("user name="), t["role"]))
        )
        return F.concat(F.lit(START), name, F.lit("\n"))

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(head(t))
        end = start + F.length(t["text"]) + len(END)
        span = F.concat(start.cast("string"), F.lit("-"), end.cast("string"), F.lit(","))
        return F.struct(
            (end + 1).alias("at"),
            F.concat(state["spans"], F.when(t["role"] == F.col("speaker"), span).otherwise("")).alias("spans"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))
    spans = F.aggregate("turns", begin, step, lambda state: F.rtrim(state["spans"], F.lit(",")))
    text = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END + "\n"))), "")
    own = F.filter("turns", lambda t: t["role"] == F.col("speaker"))
    return both.select(
        "conv_id",
        "part",
        "speaker",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size(own).cast("bigint").alias("n_trained"),
        text.alias("text"),
        spans.alias("trained"),
    )


ROTATE_SQL = f"""
WITH rows AS (
  SELECT DISTINCT conv_id, CAST(coalesce(floor(turn / {PART_TURNS}.0), -1) AS BIGINT) AS part,
    coalesce(turn, 0) AS turn,
    regexp_replace(replace(coalesce(role, '{UNKNOWN}'), '<|', '< |'), '\\s', '_', 'g') AS role,
    replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM rows WHERE role <> 'system'),
heads AS (
  SELECT r.*, speaker, '{START}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
    ELSE 'user name=' || role END || chr(10) AS head
  FROM rows r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(text) + {len(END) + 1}) OVER (
    PARTITION BY conv_id, part, speaker ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) - 1 AS ends
  FROM heads)
SELECT conv_id, part, speaker, count(*) AS n_turns, count(*) FILTER (WHERE role = speaker) AS n_trained,
  string_agg(head || text || '{END}' || chr(10), '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg(CAST(ends - length(text) - {len(END)} AS BIGINT) || '-' || CAST(ends AS BIGINT), ','
    ORDER BY turn, role, text) FILTER (WHERE role = speaker), '') AS trained
FROM placed GROUP BY conv_id, part, speaker
"""
