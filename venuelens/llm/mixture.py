"""Mixing sources to target weights by hierarchical budgets.

Sources are the leaves of a tree, such as domain, language, source. A token budget is divided
from the root down in proportion to the weights of the siblings. No node gets more than its
sources hold, counted with their repetitions; what a node cannot fill goes to its siblings in
proportion to their weights, and only what a whole family cannot fill goes to the siblings of
its parent. A leaf takes whole epochs of its documents, then the beginning of one more, in an
order seeded by the epoch, as long as its tokens suffice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.tables import written

# Fixed value: a word is a run of other characters than ASCII white space.
WORD = "[^\\x09-\\x0D\\x20]+"
UNNAMED = "unknown"
# Hex digits of a document's place in an epoch by which it is counted first.
DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """``weights`` has a mapping for each level; values it does not name weigh one. The budget
    is ``share`` of all tokens, and no document is taken more than ``epochs`` times."""

    levels: Sequence[str]
    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    share: float = 1.0
    epochs: int = 4
    seed: int = 20

    def weight(self, level: str) -> Column:
        found = F.lit(1.0)
        for value, weight in sorted(self.weights.get(level, {}).items()):
            if weight < 0:
                raise ValueError("weights must not be negative")
            found = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(found)
        return found


def tokens(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def domain(source: Column) -> Column:
    """The domain of a source: 'web' for numbers under 10, 'books' for others, 'other' without one."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(F.coalesce(number, F.lit("")) == "", "other").when(number.cast("int") < 10, "web").otherwise("books")


def place(doc_id: Column, seed: int, epoch: Column) -> Column:
    """A document's place in an epoch, as hex text to order by."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(levels, tokens, quota) from (levels, tokens): the tokens each leaf is to give.

    ``leaves`` has a row for each leaf. Level by level the parent's budget fills its children
    up to the same multiple of their weight, or as far as they hold: children are ordered by
    how soon they are full, and the largest multiple any of them would allow is the one.
    """
    levels = list(mix.levels)
    capacity = F.sum("tokens") * mix.epochs
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    held = total.select((F.col("all") * mix.share).cast("double").alias("budget"))
    above: list[str] = []
    for level in levels:
        children = leaves.groupBy(*above, level).agg(capacity.cast("double").alias("holds"))
        children = children.withColumn("w", mix.weight(level))
        # One row above the first level; below it one row for each parent.
        joined = children.join(held, above) if above else children.crossJoin(F.broadcast(held))
        family = Window.partitionBy(*[F.col(c) for c in above])
        soon = family.orderBy(F.col("holds") / F.col("w"), level)
        before = soon.rowsBetween(Window.unboundedPreceding, -1)
        after = soon.rowsBetween(0, Window.unboundedFollowing)
        multiple = (F.col("budget") - F.coalesce(F.sum("holds").over(before), F.lit(0.0))) / F.sum("w").over(after)
        weighed = joined.where("w > 0").withColumn("multiple", multiple)
        given = F.least(F.col("holds"), F.col("w") * F.max("multiple").over(family))
        above = [*above, level]
        held = weighed.select(*above, F.greatest(given, F.lit(0.0)).alias("budget"))
    quota = F.floor(F.round(F.coalesce("budget", F.lit(0.0)), 6)).cast("long")
    return leaves.join(held, levels, "left").select(*levels, "tokens", quota.alias("quota"))


def _counted(docs: DataFrame, mix: Mix, doc_id: str, text: str) -> DataFrame:
    named = [F.coalesce(F.col(c).cast("string"), F.lit(UNNAMED)).alias(c) for c in mix.levels]
    return docs.select(F.col(doc_id).alias("doc_id"), *named, tokens(F.col(text)).alias("tokens"))


def plan(counted: DataFrame, mix: Mix) -> DataFrame:
    """What each leaf takes: (levels, tokens, quota, whole, cut_bucket, cut_place, cut_id).

    ``counted`` has (doc_id, levels, tokens). ``whole`` epochs are taken in full; of the next,
    the documents before the cut. The cut is found in two steps, from totals by the first
    digits of the places and then within one such bucket, so that no leaf is ordered in one
    task. Rows that tie, which have one id, are taken together or not at all.
    """
    levels = list(mix.levels)
    leaves = written(counted.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    quotas = budgets(leaves, mix)
    whole = F.coalesce(F.floor(F.try_divide("quota", "tokens")), F.lit(0))
    rest = (F.col("quota") - F.col("whole") * F.col("tokens")).alias("rest")
    quotas = written(quotas.withColumn("whole", whole).select("*", rest), "quotas")

    taken = counted.withColumnRenamed("tokens", "size").join(quotas, levels)
    at = place(F.col("doc_id"), mix.seed, F.col("whole"))
    placed = taken.select(*levels, "rest", "doc_id", at.alias("place"), "size")
    placed = placed.groupBy(*levels, "rest", "place", "doc_id").agg(F.sum("size").alias("size"))
    placed = written(placed.withColumn("bucket", F.substring("place", 1, DIGITS)), "places")

    running = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = placed.groupBy(*levels, "rest", "bucket").agg(F.sum("size").alias("size"))
    edges = (
        buckets.withColumn("upto", F.sum("size").over(running))
        .where("upto > rest")
        .groupBy(*levels)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"))).alias("edge"))
        .select(*levels, F.col("edge.bucket").alias("bucket"), "edge.before")
    )
    edges = written(edges, "edges")
    running = (
        Window.partitionBy(*levels, "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    cuts = (
        placed.join(edges, [*levels, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("size").over(running))
        .where("upto <= rest")
        .groupBy(*levels)
        .agg(F.max(F.struct("place", "doc_id")).alias("cut"))
    )
    joined = quotas.join(edges.select(*levels, F.col("bucket").alias("cut_bucket")), levels, "left")
    joined = joined.join(cuts, levels, "left")
    return written(
        joined.select(
            *levels, "tokens", "quota", "whole", "cut_bucket",
            F.col("cut.place").alias("cut_place"), F.col("cut.doc_id").alias("cut_id"),
        ),
        "mix",
    )


def copies(mix: Mix, doc_id: Column) -> Column:
    """How often a document is taken, by its leaf's row of the plan.

    No cut bucket means that the leaf has nothing beyond its quota; no cut place that nothing
    of the cut's bucket is taken. Null ids come first in their place.
    """
    at = place(doc_id, mix.seed, F.col("whole"))
    bucket = F.substring(at, 1, DIGITS)
    upto = (at < F.col("cut_place")) | (
        (at == F.col("cut_place")) & F.coalesce(doc_id <= F.col("cut_id"), doc_id.isNull())
    )
    partly = (
        F.col("cut_bucket").isNull()
        | (bucket < F.col("cut_bucket"))
        | ((bucket == F.col("cut_bucket")) & F.coalesce(upto, F.lit(False)))
    )
    return F.least(F.col("whole") + partly.cast("long"), F.lit(mix.epochs)).cast("long")


def mixed(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, levels, tokens, epoch): every time that a document is taken.

    A null level counts as 'unknown', a null text has no tokens. Texts without tokens cost
    nothing and are taken where they fall before the cut.
    """
    counted = written(_counted(docs, mix, doc_id, text), "counted")
    leaves = plan(counted, mix)
    chosen = counted.join(leaves.drop("tokens"), list(mix.levels)).withColumn("n", copies(mix, F.col("doc_id")))
    epochs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("epoch")
    return chosen.where("n > 0").select("doc_id", *mix.levels, "tokens", epochs)


def keep_mixed(
    docs: DataFrame, mix: Mix, levels: Mapping[str, Column], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, columns as they are.

    ``levels`` gives the columns of the tree over ``docs``. Whether a row is taken follows from
    the plan's row of its leaf, so the texts are not shuffled.
    """
    named = {c: F.coalesce(v.cast("string"), F.lit(UNNAMED)) for c, v in levels.items()}
    ready = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[v.alias(c) for c, v in named.items()])
    leaves = plan(written(_counted(ready, mix, "doc_id", "text"), "counted"), mix).select(
        *[F.col(c).alias(f"__{c}") for c in mix.levels], "whole", "cut_bucket", "cut_place", "cut_id"
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("__row"), F.col(doc_id).alias("__id"), *[v.alias(c) for c, v in named.items()]
    )
    same = [rows[c] == leaves[f"__{c}"] for c in mix.levels]
    taken = rows.join(leaves, same).withColumn("n", copies(mix, F.col("__id"))).where("n > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("__row.*")
