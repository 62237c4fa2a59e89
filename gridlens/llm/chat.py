"""Multi-party perspective rotation of conversations, as rendered segments with masks.

For every participant of a conversation the dialogue is rendered with that
participant as ``assistant``, everyone else as a named ``user`` and system
turns as they are.  The result is one row per turn of each rendered dialogue:
its text, its character range in the dialogue, and the range to train on
(the assistant's words and the end mark; null elsewhere).  Joined in order of
``start`` the rows are the dialogue, so no conversation has to fit in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The marks of the rendered format.
START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM_ROLES = ("system",)
#: Turns are summed in runs of this many turn numbers first, so a huge conversation is spread.
RUN_TURNS = 256


def rotate(conversations: DataFrame, system_roles: tuple[str, ...] = SYSTEM_ROLES) -> DataFrame:
    """Rendered segments of every (conversation, participant).

    Null role is the speaker ``unknown``; null text is empty; null turns come
    last; a null conv_id is a conversation of its own.  Turns of equal number
    are ordered by speaker and text; repeated rows are all rendered.  ``<|`` in
    a text is rendered ``< |``, so no text can forge a mark.  A conversation
    with system turns only has no participant and gives no row.  Other columns
    are ignored.
    """
    turns = conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("speaker"),
        F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("body"))
    system = F.col("speaker").isin(*system_roles)
    people = turns.where(~system).select(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective")).distinct()
    rows = turns.join(people, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    own = F.col("speaker") == F.col("perspective")
    name = F.regexp_replace("speaker", "[^A-Za-z0-9_-]", "_")
    head = F.concat(F.lit(START), F.when(system, F.lit("system")).when(own, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), name)), F.lit("\n"))
    rows = (rows.withColumn("_head", F.length(head)).withColumn("segment", F.concat(head, F.col("body"), F.lit(END)))
            .withColumn("_len", F.length("segment").cast("long"))
            .withColumn("_run", F.coalesce(F.floor(F.col("turn") / RUN_TURNS), F.lit((1 << 62)))))
    group = ["conv_id", "perspective"]
    runs = rows.groupBy(*group, "_run").agg(F.sum("_len").alias("_sum"), F.count("*").alias("_cnt"))
    before = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("_run").alias("_r"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_chars"),
                       F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_rows"))
    rows = rows.join(runs, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("_run") == F.col("_r")))
    inside = Window.partitionBy(*group, "_run").orderBy(F.col("turn").asc_nulls_last(), "speaker", "body")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("_chars") + F.sum("_len").over(upto) - F.col("_len")
    rows = rows.withColumn("start", start).withColumn("position", F.col("_rows") + F.row_number().over(inside) - 1)
    return rows.select(
        "conv_id", "perspective", F.col("position").cast("long").alias("position"), "turn", "speaker", "segment",
        F.col("start").cast("long").alias("start"), (F.col("start") + F.col("_len")).cast("long").alias("end"),
        F.when(own, F.col("start") + F.col("_head")).cast("long").alias("mask_start"),
        # the end mark is learned, the line feed after it is not
        F.when(own, F.col("start") + F.col("_len") - 1).cast("long").alias("mask_end"))


ROTATE_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations
), p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
j AS (
  SELECT t.conv_id, p.perspective, t.turn, t.speaker, t.body,
         '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.perspective THEN 'assistant'
           ELSE 'user name=' || regexp_replace(t.speaker, '[^A-Za-z0-9_-]', '_', 'g') END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), s AS (
  SELECT *, head || body || '<|im_end|>' || chr(10) AS segment FROM j
), w AS (
  SELECT *, row_number() OVER o - 1 AS position,
         CAST(sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING) - length(segment) AS BIGINT) AS start
  FROM s WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, body)
)
SELECT conv_id, perspective, position, turn, speaker, segment, start, start + length(segment) AS "end",
       CASE WHEN speaker = perspective THEN start + length(head) END AS mask_start,
       CASE WHEN speaker = perspective THEN start + length(segment) - 1 END AS mask_end
FROM w
"""
