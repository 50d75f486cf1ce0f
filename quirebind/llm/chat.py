"""Chat formatting by perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and all others as named users; only the assistant's turns
are trained on.  System turns belong to nobody.

A dialogue is a set of rows in order, one per turn, each with its text and its
place in the whole.  So a conversation of any length takes no more room in a task
than its share of rows: turns are range-partitioned by conversation and order,
stored, added up inside each part, and the parts' totals (one row per
conversation, speaker and part) are added up across the seams.

Defined cases: a null text is empty; a null role is the participant ``unknown``;
null conv_ids form one conversation; turns of the same number are ordered by role,
then text, null turns first; repeated rows are turns of their own; a conversation
of system turns alone has no participant and no row; an empty table gives an empty
result; further columns are dropped.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebind.session import settle

# --- fixed values: marks and roles ----------------------------------------------
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, ASSISTANT, USER, UNKNOWN = "system", "assistant", "user", "unknown"
# --- end of fixed values --------------------------------------------------------


def _head(role: Column, name: Column) -> Column:
    named = F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise("")
    return F.concat(F.lit(OPEN), role, named, F.lit("\n"))


def rotated(conversations: DataFrame) -> DataFrame:
    """conv_id, speaker, position (from 0), turn, role, name, trained, text (rendered),
    char_start, char_end, train_start, train_end (null where not trained).

    Places are code points in the rendered dialogue of the speaker; a mask is the
    set of its trained places: the turn's own text and its closing mark.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN)).alias("author"),
        F.coalesce("text", F.lit("")).alias("body"),
    )
    order = ["turn", "author", "body"]
    tie = turns.withColumn("deal", F.rand(5))
    placed = settle(
        tie.repartitionByRange("conv_id", *order, "deal")
        .drop("deal").withColumn("part", F.spark_partition_id())
    )
    speakers = placed.filter(F.col("author") != SYSTEM).select(
        F.col("conv_id").alias("of"), F.col("author").alias("speaker")
    ).distinct()
    seen = placed.join(speakers, placed["conv_id"].eqNullSafe(speakers["of"])).drop("of")
    mine = F.col("author") == F.col("speaker")
    system = F.col("author") == SYSTEM
    shown = seen.select(
        "conv_id", "speaker", "turn", "author", "body", "part",
        F.when(mine, ASSISTANT).when(system, SYSTEM).otherwise(USER).alias("role"),
        F.when(~mine & ~system, F.col("author")).alias("name"),
    )
    shown = shown.withColumn("head", F.length(_head(F.col("role"), F.col("name"))))
    shown = shown.withColumn("size", F.col("head") + F.length("body") + F.lit(len(CLOSE)))
    own = Window.partitionBy("conv_id", "speaker", "part").orderBy(*order)
    until = own.rowsBetween(Window.unboundedPreceding, 0)
    local = shown.select(
        "*", (F.row_number().over(own) - 1).alias("n"), F.sum("size").over(until).alias("upto")
    )
    before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0).cast("bigint")
    totals = shown.groupBy("conv_id", "speaker", "part").agg(
        F.count("*").alias("rows"), F.sum("size").alias("chars")
    ).select(
        F.col("conv_id").alias("c"), F.col("speaker").alias("s"), F.col("part").alias("p"),
        F.coalesce(F.sum("rows").over(before), zero).alias("rows_before"),
        F.coalesce(F.sum("chars").over(before), zero).alias("chars_before"),
    )
    key = (
        local["conv_id"].eqNullSafe(totals["c"]) & (local["speaker"] == totals["s"])
        & (local["part"] == totals["p"])
    )
    end = F.col("chars_before") + F.col("upto")
    start = end - F.col("size")
    trained = F.col("role") == ASSISTANT
    return local.join(totals, key).select(
        "conv_id", "speaker", (F.col("rows_before") + F.col("n")).cast("bigint").alias("position"),
        "turn", "role", "name", trained.alias("trained"),
        F.concat(_head(F.col("role"), F.col("name")), "body", F.lit(CLOSE)).alias("text"),
        start.alias("char_start"), end.alias("char_end"),
        F.when(trained, start + F.col("head")).alias("train_start"),
        F.when(trained, end).alias("train_end"),
    )


ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS author, coalesce(text, '') AS body
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id AS of, author AS speaker FROM turns WHERE author <> '{SYSTEM}'
), shown AS (
  SELECT conv_id, speaker, turn, author, body,
    CASE WHEN author = speaker THEN '{ASSISTANT}' WHEN author = '{SYSTEM}' THEN '{SYSTEM}'
         ELSE '{USER}' END AS role,
    CASE WHEN author <> speaker AND author <> '{SYSTEM}' THEN author END AS name
  FROM turns JOIN speakers ON conv_id IS NOT DISTINCT FROM of
), sized AS (
  SELECT *, '{OPEN}' || role || coalesce(' name=' || name, '') || chr(10) AS head,
  FROM shown
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    sum(length(head) + length(body) + {len(CLOSE)}) OVER w AS upto
  FROM sized
  WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, author, body
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), spans AS (
  SELECT *, CAST(upto AS BIGINT) AS char_end,
    CAST(upto - length(head) - length(body) - {len(CLOSE)} AS BIGINT) AS char_start
  FROM placed
)
SELECT conv_id, speaker, position, turn, role, name, role = '{ASSISTANT}' AS trained,
  head || body || '<|im_end|>' || chr(10) AS text, char_start, char_end,
  CASE WHEN role = '{ASSISTANT}' THEN CAST(char_start + length(head) AS BIGINT) END AS train_start,
  CASE WHEN role = '{ASSISTANT}' THEN char_end END AS train_end
FROM spans
"""
