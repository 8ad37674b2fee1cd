"""Leaderboards and ranks. Every order ends in the venue id, so it is total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.functions.columns import value_per_hundred
from venuelens.operators.ordering import dense_ranks, ranks_in
from venuelens.sources.shared import written

BOARD = ["venue_id", "venue_name", "city", "locality", "cuisines", "cost", "rating", "votes"]


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows by a full ordering; planned as a per-task top-k and a merge."""
    return df.orderBy(*order).limit(n)


def top_rated(fact: DataFrame, n: int = 15) -> DataFrame:
    rows = fact.where("credible").select(*BOARD)
    return top_n(rows, n, F.desc("rating"), F.desc("votes"), "venue_id")


def most_expensive(fact: DataFrame, n: int = 15) -> DataFrame:
    rows = fact.where(F.col("cost").isNotNull()).select(*BOARD)
    return top_n(rows, n, F.desc("cost"), "venue_id")


def best_value(fact: DataFrame, n: int = 15, rating_floor: float = 4.0) -> DataFrame:
    """Stars per 100 of cost; the rating floor keeps cheap-and-bad off the board."""
    good = fact.where(F.col("credible") & (F.col("rating") >= rating_floor) & (F.col("cost") > 0))
    stars = value_per_hundred(F.col("rating"), F.col("cost")).alias("stars_per_100")
    return top_n(good.select(*BOARD, stars), n, F.desc("stars_per_100"), "venue_id")


def most_voted(fact: DataFrame, n: int = 15) -> DataFrame:
    return top_n(fact.select(*BOARD), n, F.desc_nulls_last("votes"), "venue_id")


def name_ranks(fact: DataFrame, digits: int = 9) -> DataFrame:
    """Dense ranks of each venue name by mean cost and mean rating, inside the selection.

    A name with no cost has no cost rank, one with no credible venue no rating rank.
    Means are rounded before they are compared, so equal means share a rank. They come from
    exact sums, so that every evaluation of a mean, in whatever row order, is the same number
    and meets its rank.
    """

    def mean(column: str) -> Column:
        exact = F.sum(F.col(column).cast("decimal(38,16)")).cast("double")
        return F.round(F.try_divide(exact, F.count(column)), digits)

    names = (
        fact.where(F.col("venue_name").isNotNull())
        .groupBy("venue_name")
        .agg(
            mean("cost").alias("mean_cost"),
            mean("rating").alias("mean_rating"),
            F.count_if("credible").alias("credible_n"),
        )
    )
    names = written(names, "names")
    ranks = dense_ranks(names, "mean_cost", "mean_rating")
    by_cost = ranks_in(ranks, "mean_cost", "mean_cost", "cost_rank")
    by_rating = ranks_in(ranks, "mean_rating", "mean_rating", "any_rating_rank")
    rating_rank = F.when(F.col("credible_n") > 0, F.col("any_rating_rank"))
    return (
        names.join(by_cost, "mean_cost", "left")
        .join(by_rating, "mean_rating", "left")
        .select("venue_name", "mean_cost", "mean_rating", "cost_rank", rating_rank.alias("rating_rank"))
    )


def scatter_points(fact: DataFrame, max_cost: float = 4000) -> DataFrame:
    """Credible venues with a known cost up to the axis limit."""
    wanted = F.col("credible") & F.col("rating").isNotNull() & (F.col("cost") <= max_cost)
    return fact.where(wanted).select(
        "venue_id", "venue_name", "city", "cost", "rating", "votes", "price_label"
    )


def seeded_sample(df: DataFrame, n: int = 700, seed: int = 42, key: str = "venue_id") -> DataFrame:
    """At most ``n`` rows, the same ones on every run: the smallest keyed hashes."""
    ticket = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return top_n(df.withColumn("_ticket", ticket), n, "_ticket", key).drop("_ticket")


def first_of(rows: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group; a rank under a fixed limit plans as a group limit in each task."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_place", rank).where("_place <= 1").drop("_place")


@dataclass(frozen=True)
class Board:
    """A top-k table: who is eligible, what counts (largest first, nulls last), and how many."""

    eligible: Column
    order: tuple[Column, ...]
    n: int
    # Smallest first, where ``order`` ties or is empty; the venue id is always last.
    ticket: Column | None = None


def standard_boards(max_point_cost: float, n: int = 15, points: int = 700, seed: int = 42, rating_floor: float = 4.0) -> dict[str, Board]:
    """The four leaderboards and the seeded sample of scatter points."""
    rating, cost, votes = F.col("rating"), F.col("cost"), F.col("votes")
    good = F.col("credible") & (rating >= rating_floor) & (cost > 0)
    shown = F.col("credible") & rating.isNotNull() & (cost <= max_point_cost)
    return {
        "top_rated": Board(F.col("credible"), (rating, votes), n),
        "most_expensive": Board(cost.isNotNull(), (cost,), n),
        "best_value": Board(good, (value_per_hundred(rating, cost),), n),
        "most_voted": Board(F.lit(True), (votes,), n),
        "cost_vs_rating": Board(shown, (), points, F.md5(F.concat(F.col("venue_id").cast("string"), F.lit(f":{seed}")))),
    }


def places(fact: DataFrame, boards: Mapping[str, Board]) -> DataFrame:
    """(board, place, venue_id) of several boards from one scan of the columns they order by.

    Every venue is put up for the boards it is eligible for, with numbers and its id only. A rank under a
    fixed limit plans as a group limit in each task, so a task sends its best rows of each board.
    """
    width = max(len(b.order) for b in boards.values())

    def entry(name: str, board: Board) -> Column:
        keys = [*board.order, *[F.lit(None)] * (width - len(board.order))]
        fields = [k.cast("double").alias(f"k{i}") for i, k in enumerate(keys)]
        ticket = board.ticket if board.ticket is not None else F.lit("")
        row = F.struct(F.lit(name).alias("board"), *fields, ticket.alias("ticket"))
        return F.when(F.coalesce(board.eligible, F.lit(False)), row)

    entries = F.filter(F.array(*[entry(*item) for item in boards.items()]), lambda e: e.isNotNull())
    put_up = fact.select("venue_id", F.inline(entries))
    order = [*[F.desc_nulls_last(f"k{i}") for i in range(width)], F.col("ticket"), F.col("venue_id")]
    rank = F.row_number().over(Window.partitionBy("board").orderBy(*order))
    most = F.coalesce(*[F.when(F.col("board") == name, F.lit(b.n)) for name, b in boards.items()])
    kept = put_up.withColumn("place", rank).where(F.col("place") <= max(b.n for b in boards.values()))
    return kept.where(F.col("place") <= most).select("board", "place", "venue_id")


def with_places(fact: DataFrame, placed: DataFrame) -> DataFrame:
    """The venues of ``places`` with all their columns: few rows, sent to one scan of the fact."""
    return fact.join(F.broadcast(placed), "venue_id")
