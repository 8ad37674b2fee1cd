"""Multi-party chat formatting by perspective rotation.

For every participant of a dialogue the whole dialogue is rendered once more: that speaker is
the assistant, all others are named users, system turns stay what they are. The mask lists
the character spans to learn from: what the assistant says, with its end mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.tables import written

# The marks of the rendered format.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
# A speaker that is not named.
UNNAMED = "unknown"
# New turns in each of the windows in which a dialogue is rendered.
WINDOW = 64
# Turns before a window that are shown in it again.
BEFORE = 16


def _plain(text: Column) -> Column:
    """Text that cannot be taken for a mark."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotated(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(conv_id, perspective, window, part, n_turns, n_learned, text, mask): the dialogues as texts.

    mask is an array of (start, stop) character offsets into text. Speakers are the distinct
    values of ``speaker`` other than 'system', null counting as 'unknown'; a dialogue
    of system turns only has no perspective and no rendering. Turns are ordered by number, then
    speaker, then text, null numbers first; equal rows are rendered once. A null
    text is an empty turn, and a null dialogue id is a dialogue of its own.

    A dialogue is cut by position into windows of ``window`` turns, so that none meets in one task
    however many turns it has; one of up to ``window`` turns is one text. Before its own
    turns a further window shows the dialogue's first ``window`` system turns and the ``BEFORE``
    turns that precede it; n_turns and the mask leave these out. Turns are whole, however
    long. The column part is 0.
    """
    said = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(speaker), F.lit(UNNAMED)).alias("speaker"),
        _plain(F.col(text)).alias("said"),
    ).distinct()
    said = written(said, "said")
    # The others are one window, and need not be counted through.
    large = said.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > window)
    same = F.col("s.conv_id").eqNullSafe(F.col("l.conv_id"))
    of = said.alias("s"), large.select("conv_id").alias("l")
    small = of[0].join(of[1], same, "left_anti").select(
        "s.*", F.lit(0).cast("long").alias("window"), F.lit(False).alias("again")
    )
    shown = small.unionByName(_cut(of[0].join(of[1], same, "left_semi").select("s.*"), window))
    heard = F.sort_array(F.collect_list(F.struct("turn", "speaker", "said", "again")))
    windows = shown.groupBy("conv_id", "window").agg(heard.alias("turns")).withColumn("part", F.lit(0).cast("long"))

    people = said.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    same = F.col("w.conv_id").eqNullSafe(F.col("p.conv_id"))
    seen = windows.alias("w").join(people.alias("p"), same).select("w.*", "p.perspective")

    def segment(t: Column) -> Column:
        own = t["speaker"] == F.col("perspective")
        head = (
            F.when(own, F.lit(f"{START}assistant\n"))
            .when(t["speaker"] == SYSTEM, F.lit(f"{START}system\n"))
            .otherwise(F.concat(F.lit(f"{START}user name="), _plain(t["speaker"]), F.lit("\n")))
        )
        body = F.concat(t["said"], F.lit(END))
        return F.struct((own & ~t["again"]).alias("own"), t["again"].alias("again"), F.length(head).alias("head"), F.length(body).alias("body"),
                        F.concat(head, body, F.lit("\n")).alias("text"))

    begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("mask"))

    def further(state: Column, s: Column) -> Column:
        start = state["at"] + s["head"]
        span = F.array(F.struct(start.alias("start"), (start + s["body"]).alias("stop")))
        mask = F.when(s["own"], F.concat(state["mask"], span)).otherwise(state["mask"])
        return F.struct((start + s["body"] + 1).alias("at"), mask.alias("mask"))

    parted = seen.withColumn("segments", F.transform("turns", segment))
    whole = parted.withColumn("mask", F.aggregate("segments", begun, further)["mask"])
    learned = F.aggregate("mask", F.lit(0).cast("long"), lambda n, m: n + m["stop"] - m["start"])
    return whole.select(
        "conv_id", "perspective", "window", "part", F.size(F.filter("segments", lambda s: ~s["again"])).cast("long").alias("n_turns"),
        learned.alias("n_learned"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"), "mask",
    )


def _cut(said: DataFrame, step: int) -> DataFrame:
    """Turns with the window they are new in, and again (``again``) with those that show them once more.

    Places are running counts: rows are dealt into ordered ranges, counted in each, and the
    counts of the ranges before are added.
    """
    pieces = int(said.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "speaker", "said"]
    dealt = said.repartitionByRange(pieces, "conv_id", *order).withColumn("piece", F.spark_partition_id())
    dealt = written(dealt.withColumn("rule", (F.col("speaker") == SYSTEM).cast("long")), "ranges")
    counts = dealt.groupBy("conv_id", "piece").agg(F.count("*").alias("rows"), F.sum("rule").alias("rules"))
    # One row for each range of a dialogue.
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("conv_id").alias("c"), F.col("piece").alias("p"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("rules").over(earlier), F.lit(0)).alias("rules_before"),
        F.sum("rows").over(Window.partitionBy("conv_id")).alias("total"),
    )
    inside = Window.partitionBy("conv_id", "piece").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("at", F.row_number().over(inside) - 1).withColumn("nth", F.sum("rule").over(upto))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p"))
    placed = placed.join(counts, same).withColumn("at", F.col("at") + F.col("rows_before"))
    own, last = F.floor(F.col("at") / step), F.floor((F.col("total") - 1) / step)
    carried = (F.col("rule") == 1) & (F.col("nth") + F.col("rules_before") <= step)
    # A turn near its window's end is shown in those that begin within ``BEFORE`` turns.
    until = F.least(last, F.when(carried, last).otherwise(F.floor((F.col("at") + BEFORE) / step)))
    shown = placed.withColumn("own", own).withColumn("window", F.explode(F.sequence(own, until)))
    return shown.select("conv_id", *order, "window", (F.col("window") > F.col("own")).alias("again"))


ORACLE = f"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '{UNNAMED}') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> '{SYSTEM}'
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, said) - 1 AS num,
         sum(CASE WHEN speaker = '{SYSTEM}' THEN 1 ELSE 0 END) OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, said ROWS UNBOUNDED PRECEDING) AS nth,
         (count(*) OVER (PARTITION BY conv_id) - 1) // {WINDOW} AS last
  FROM said
), shown AS (
  SELECT conv_id, turn, speaker, said, num // {WINDOW} AS own_window,
         CAST(unnest(range(num // {WINDOW}, least(last,
           CASE WHEN speaker = '{SYSTEM}' AND nth <= {WINDOW} THEN last ELSE (num + {BEFORE}) // {WINDOW} END) + 1)) AS BIGINT) AS "window"
  FROM counted
), parts AS (
  SELECT s.conv_id, p.perspective, s.turn, s.speaker, s.said, s."window",
         "window" > own_window AS again,
         s.speaker = p.perspective AND "window" = own_window AS own,
         CASE WHEN s.speaker = p.perspective THEN '{START}assistant' || chr(10)
              WHEN s.speaker = '{SYSTEM}' THEN '{START}system' || chr(10)
              ELSE '{START}user name=' || replace(s.speaker, '<|', '< |') || chr(10) END AS head,
         s.said || '{END}' AS body
  FROM shown s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, CAST(sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, perspective, "window" ORDER BY turn NULLS FIRST, speaker, said
         ) AS BIGINT) - length(body) - 1 AS start
  FROM parts
)
SELECT conv_id, perspective, "window", CAST(0 AS BIGINT) AS part, count(*) FILTER (WHERE NOT again) AS n_turns,
       CAST(coalesce(sum(length(body)) FILTER (WHERE own), 0) AS BIGINT) AS n_learned,
       string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, speaker, said) AS text,
       coalesce(string_agg(start || ':' || (start + length(body)), ',' ORDER BY start) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, perspective, "window"
"""


def digest(rendered: DataFrame) -> DataFrame:
    """The rendering with its mask as text, ``start:stop`` with commas between."""
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["stop"]))
    return rendered.withColumn("mask", F.array_join(spans, ","))
