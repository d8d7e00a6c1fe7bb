"""Operator 3: multi-party perspective rotation (DataFrame operations only).

For every participant of a conversation the whole dialogue is rendered once
with that speaker as ``assistant`` and the others as named users; messages of a
context role (``system``) keep it and have no perspective of their own.  The
result has one row per perspective and message: the rendered segment, its place
in the rendered dialogue and the span that is trained on (the assistant's
content and end mark; null for others), in code points.  Joining a dialogue's
segments in order of ``start`` gives its text.

Messages are ordered by turn (null first), then by the MD5 of speaker and text.
Places are prefix sums in four levels (within a turn's hash range, within the
turn, within ``BLOCK`` turns, within the conversation), so no window holds a
long conversation or a crowded turn whole; equal messages are summed up before.
All that works on lengths; the texts are shuffled once, to join their places.
Messages meet their conversation's participants under ``SALTS`` salts; copies of a
message are written out by blocks of ``COPIES``, each with a copy of the text.

Defined cases: a null role is the speaker ``unknown``; a null text is empty;
equal rows are messages of their own, one after the other; a conversation with
context messages only has no perspective and no rows; a null conversation id is
a conversation; an empty table gives an empty result; extra columns are
ignored.  ``<|`` in a text or name is written ``< |``, so no text ends a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlens.llm.common import cut_lineage

CONTEXT = "system"
BLOCK = 256
SALTS = 16
COPIES = 10_000
_BEGIN, _END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _before(parts: DataFrame, within: list[str], order: list[str], amount: str, name: str) -> DataFrame:
    """``parts`` with the sum of ``amount`` of the earlier rows within the same keys."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, F.coalesce(F.sum(amount).over(w), F.lit(0)))


def _matched(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    b = b.select(*(F.col(k).alias(f"__{k}") if k in keys else k for k in b.columns))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return a.join(b, condition).drop(*(f"__{k}" for k in keys))


def rotate(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", context: str = CONTEXT) -> DataFrame:
    """conv id, perspective, turn, speaker, role, segment, start, stop, mask_start, mask_stop."""
    message = ["conv", "turn", "speaker", "h"]
    m = (messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                         F.coalesce(role_col, F.lit("unknown")).alias("speaker"),
                         F.coalesce(text_col, F.lit("")).alias("content"))
         .withColumn("h", F.md5(F.concat_ws("\n", "speaker", "content"))))
    # places need lengths only; the texts join them at the end
    slim = cut_lineage(m.groupBy(*message).agg(
        F.count("*").alias("copies"), F.max(F.char_length(_plain(F.col("content")))).alias("length"))
        .withColumn("salt", F.pmod(F.xxhash64("turn", "h"), F.lit(SALTS)).cast("int")))
    people = (slim.filter(F.col("speaker") != context).select("conv", F.col("speaker").alias("perspective")).distinct()
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    rows = _matched(slim, people, ["conv", "salt"]).drop("salt")

    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == context, context).otherwise("user")
    head = F.concat(F.lit(_BEGIN), F.col("role"), F.when(
        F.col("role") == "user", F.concat(F.lit(" name="), _plain(F.col("speaker")))).otherwise(""), F.lit("\n"))
    rows = cut_lineage(
        rows.withColumn("role", role).withColumn("head", head)
        .withColumn("size", (F.char_length("head") + F.col("length") + len(_END) + 1).cast("long"))
        .withColumn("total", F.col("size") * F.col("copies"))
        .withColumn("slot", F.substring("h", 1, 2))
        .withColumn("block", F.floor(F.coalesce("turn", F.lit(0)) / BLOCK)).drop("length"))

    talk = ["conv", "perspective"]
    levels = [("slot", [*talk, "block", "turn", "slot"]), ("turn", [*talk, "block", "turn"]), ("block", [*talk, "block"])]
    sums, below = [], rows
    for _, keys in levels:
        below = below.groupBy(*keys).agg(F.sum("total").alias("total"))
        sums.append(below)
    # from the conversation down: the place where a block, a turn, a slot begins
    place = _before(sums[2], talk, ["block"], "total", "place").drop("total")
    for (name, keys), upper in zip(levels[1::-1], (levels[2][1], levels[1][1]), strict=True):
        inner = _before(sums[0] if name == "slot" else sums[1], upper, [name], "total", "inner").drop("total")
        place = _matched(inner, place, upper).withColumn("place", F.col("place") + F.col("inner")).drop("inner")
    slot = levels[0][1]
    rows = _matched(_before(rows, slot, ["h", "speaker"], "total", "inner"), place, slot)
    zero = F.lit(0).cast("long")
    deal = F.explode(F.sequence(zero, F.floor((F.col("copies") - 1) / COPIES)))
    texts = (m.groupBy(*message).agg(F.first("content").alias("content"), F.count("*").alias("copies"))
             .select(*message, F.concat(_plain(F.col("content")), F.lit(f"{_END}\n")).alias("said"), deal.alias("deal")))
    rows = _matched(rows.withColumn("deal", deal), texts, [*message, "deal"]).withColumn("segment", F.concat("head", "said"))
    first = F.col("deal") * COPIES
    rows = rows.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES, F.col("copies")) - 1)))
    start = F.col("place") + F.col("inner") + F.col("copy") * F.col("size")
    trained = F.col("role") == "assistant"
    return rows.withColumn("start", start).select(
        F.col("conv").alias(conv_col), "perspective", F.col("turn").alias(turn_col), "speaker", "role", "segment",
        "start", (F.col("start") + F.col("size")).alias("stop"),
        F.when(trained, F.col("start") + F.char_length("head")).alias("mask_start"),
        F.when(trained, F.col("start") + F.col("size") - 1).alias("mask_stop"))  # without the line end


def op3_perspectives(spark, sf_dir: str) -> DataFrame:
    return rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = """
WITH m AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
r AS (
  SELECT m.conv_id, p.perspective, m.turn, m.speaker, m.content, md5(m.speaker || chr(10) || m.content) AS h,
         CASE WHEN m.speaker = p.perspective THEN 'assistant' WHEN m.speaker = 'system' THEN 'system'
              ELSE 'user' END AS role
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || replace(speaker, '<|', '< |')
            ELSE '' END || chr(10) AS head FROM r),
t AS (SELECT *, head || replace(content, '<|', '< |') || '<|im_end|>' || chr(10) AS segment FROM s),
u AS (
  SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective
           ORDER BY turn NULLS FIRST, h, speaker, content
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM t)
SELECT conv_id, perspective, turn, speaker, role, segment, start, start + length(segment) AS stop,
       CASE WHEN role = 'assistant' THEN start + length(head) END AS mask_start,
       CASE WHEN role = 'assistant' THEN start + length(segment) - 1 END AS mask_stop
FROM u
"""
