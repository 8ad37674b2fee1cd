"""Measures against brute force on small frames, hot keys and empty input included."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from venuelens.config import FilterSpec, PRICE_LABELS, Bands, COST_BANDS
from venuelens.functions import columns as C
from venuelens.functions import statistics as S
from venuelens.operators import checks, dimensions, filters, measures, opportunity, ordering, ranking
from venuelens.schemas import FACT

slow = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def make_rows(n=900, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        city = "Hot City" if i % 3 == 0 else f"City {rng.randrange(6)}"
        rating = rng.choice([None, *[x / 10 for x in range(18, 50)]])
        votes = rng.randrange(0, 400)
        cost = rng.choice([None, 150.0, 300.0, 450.0, 700.0, 1500.0, 2600.0])
        tier = rng.randrange(1, 4)
        kinds = rng.sample(["Thai", "Chinese", "Cafe", "Mughlai", "Italian"], rng.randrange(1, 4))
        rows.append(
            dict(
                venue_id=i, venue_name=f"V{rng.randrange(300)}", country_code=1, country="India", city=city,
                locality=f"{city} L{rng.randrange(4)}", address="a", longitude=1.0, latitude=1.0, geo_valid=True,
                cuisines=", ".join(kinds), cuisine_count=len(kinds), currency="Indian Rupees(Rs.)", cost=cost,
                cost_band=None, price_range=tier, price_label=PRICE_LABELS[tier], has_booking=rng.random() < 0.2,
                has_delivery=rng.random() < 0.4, delivering_now=None, rating=rating, is_rated=rating is not None,
                credible=rating is not None and votes >= 50, rating_text="x", votes=votes, has_votes=votes > 0,
                value_score=None, cuisine_list=kinds,
            )
        )
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def fact(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in FACT.names) for r in rows], FACT).cache()


@pytest.fixture(scope="module")
def frame(rows):
    df = pd.DataFrame(rows)
    df["rating"] = df["rating"].astype(float)
    df["cost"] = df["cost"].astype(float)
    return df


@pytest.fixture(scope="module")
def empty(fact):
    return fact.where("venue_id < 0")


def one(df):
    return df.first().asDict()


# -- order statistics -------------------------------------------------------
@slow
@given(
    st.lists(
        st.one_of(st.floats(-1e12, 1e12), st.sampled_from([0.0, -0.0, 7.5, 7.5])), min_size=1, max_size=60
    ),
    st.floats(0, 1),
)
def test_quantiles_match_numpy(spark, numbers, p):
    df = spark.createDataFrame([(float(x),) for x in numbers], "x double")
    got = ordering.quantiles(df, "x", {"q": p, "half": 0.5}).first()
    assert got.q == pytest.approx(np.quantile(numbers, p), rel=1e-9, abs=1e-9)
    assert got.half == pytest.approx(np.median(numbers), rel=1e-9, abs=1e-9)


def test_quantiles_by_key(fact, frame):
    got = {r.city: r.m for r in ordering.quantiles(fact, "cost", {"m": 0.5, "h": 0.9}, ["city"]).collect()}
    assert got == pytest.approx(frame.groupby("city")["cost"].median().to_dict())


def test_quantiles_of_a_hot_value(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 20_000, 5.0).otherwise(F.col("id") + 0.5).alias("x"))
    values = [5.0] * 20_000 + [i + 0.5 for i in range(20_000, 30_000)]
    got = ordering.quantiles(df, "x", {"a": 0.5, "b": 0.9}).first()
    assert (got.a, got.b) == (pytest.approx(np.quantile(values, 0.5)), pytest.approx(np.quantile(values, 0.9)))


def test_quantiles_of_nothing(empty):
    assert one(ordering.quantiles(empty, "cost", {"q": 0.5})) == {"q": None}
    assert ordering.quantiles(empty, "cost", {"q": 0.5}, ["city"]).count() == 0


@slow
@given(st.lists(st.sampled_from([-3.0, -2.999, 0.0, 1.0, 1.0005, 2.5, 1e6, 1e6 + 1]), min_size=3, max_size=40))
def test_ranks_match_pandas(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double").withColumn("w", F.lit(1))
    series = pd.Series(numbers)
    average = {r.x: r["rank"] for r in ordering.average_ranks(df, "x", "w").collect()}
    dense = {r.value: r["rank"] for r in ordering.dense_ranks(df, "x").collect()}
    assert [average[x] for x in numbers] == list(series.rank())
    assert [dense[x] for x in numbers] == list(series.rank(method="dense", ascending=False))


# Distributions that lie inside a handful of the equal-width buckets.
NARROW = {
    "shares near 0": "id * 0.003 / 60000",
    "longitudes of one town": "77.1 + id * 0.2 / 60000",
    "means within 0.1 %": "-250000 + id * 500.0 / 60000",
    "a cluster and an outlier": "if(id = 0, 1000.9, 1000 + id * 0.00001 / 60000)",
}


@pytest.mark.parametrize("values", NARROW.values(), ids=NARROW.keys())
def test_narrow_values_are_split_over_pieces(spark, monkeypatch, values):
    monkeypatch.setattr(ordering, "PIECE", 4_096)
    df = spark.range(60_000).selectExpr(f"cast({values} as double) as x", "1 as w")
    placed = ordering.ranged(df, ["x"])
    assert placed.groupBy("_piece").count().agg(F.max("count")).first()[0] <= 4_096
    plain = df.toPandas()["x"]
    ranks = {r.x: r["rank"] for r in ordering.average_ranks(df, "x", "w").collect()}
    assert [ranks[x] for x in plain] == list(plain.rank())
    got = ordering.quantiles(df, "x", {"a": 0.25, "b": 0.999}).first()
    assert (got.a, got.b) == pytest.approx((np.quantile(plain, 0.25), np.quantile(plain, 0.999)), rel=1e-12)


def test_a_tight_cluster_beside_an_outlier_ends_in_small_ranges(spark):
    """A million values inside 1e-9 of each other: ranges are counted, not trusted."""
    df = spark.range(1_000_001).selectExpr("if(id = 0, 5000.0D, 1 + id * 1e-15D) as x", "1 as w").groupBy("x").agg(F.sum("w").alias("w"))
    placed = ordering.ranged(df, ["x"], piece=10_000)
    sizes = placed.groupBy("_piece").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_piece").collect()
    assert max(r.n for r in sizes) < 10_000 and sum(r.n for r in sizes) == df.count()
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:], strict=False))


def test_ranges_are_dealt_again_until_none_is_large(spark, monkeypatch):
    """Whatever the first boundaries are worth, the counted ranges decide."""
    df = spark.range(3_000).selectExpr("id * 1.0D as x")
    dealt = []
    first = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, n, *c: dealt.append(n) or first(self, n if len(dealt) > 1 else 2, *c))
    assert ordering.ranged(df, ["x"], piece=200).groupBy("_piece").count().agg(F.max("count")).first()[0] <= 200
    assert len(dealt) >= 2 and dealt[1] == 2 * dealt[0]


def test_quantiles_of_numbered_values(spark):
    df = spark.range(2_000).selectExpr("cast(pow(id % 700, 2) as double) as x", "if(id % 3 = 0, null, 1.0D * (id % 11)) as y")
    got = ordering.numbered(df, {"x": F.col("x"), "y": F.col("y")}, F.lit(1))
    plain = df.toPandas()
    for name in ("x", "y"):
        q = ordering.quantiles_of(got.where(F.col("series") == name), {"a": 0.5, "b": 0.93}).first()
        assert (q.a, q.b) == (pytest.approx(plain[name].quantile(0.5)), pytest.approx(plain[name].quantile(0.93)))
    assert ordering.quantiles_of(got.limit(0), {"a": 0.5}).first().a is None


def test_dictionary_codes(spark):
    words = [f"w{random.Random(i).randrange(500)}" for i in range(2_000)] + [None]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(7)
    got = {r.w: r.code for r in dimensions.dictionary_codes(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted({w for w in words if w}))}


def test_dictionaries_share_one_distinct_sort_and_checkpoint(spark, monkeypatch):
    plans, frame_type = [], type(spark.range(1))
    cut = frame_type.checkpoint

    def recorded(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, *args)

    monkeypatch.setattr(frame_type, "checkpoint", recorded)
    pick = random.Random(5)
    table = [(f"a{pick.randrange(300)}", pick.choice(["x", None, "", "\u00e9"]), f"b{i % 900}") for i in range(3_000)]
    df = spark.createDataFrame(table, "p string, q string, r string").repartition(6)
    codes = dimensions.dictionaries([(df, ["p", "q"]), (df, ["r"]), (df.selectExpr("cast(null as string) as z"), ["z"])])
    got = {(r.field, r.value): r.code for r in codes.collect()}
    expected = {}
    for name, values in zip("pqr", zip(*table)):
        expected |= {(name, v): i for i, v in enumerate(sorted({v for v in values if v is not None}))}
    assert got == expected
    assert len(plans) == 1 and plans[0].count("Exchange rangepartitioning") == 1
    assert plans[0].count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        dimensions.dictionaries([(df, ["p"]), (df, ["p"])])


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_encode_by_both_joins(spark, threshold):
    """A broadcast and a shuffle join give the same codes."""
    codes = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "w string, code int")
    df = spark.createDataFrame([("b",), ("z",), (None,)], "w string")
    lists = [(1, ["c", "a"]), (2, []), (3, ["z", "b"]), (4, None), (5, [None, "a"])]
    listed = spark.createDataFrame(lists, "id int, ws array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = dimensions.encode(df, "w", codes, "c").collect()
        coded = dimensions.encode_list(listed, "id", "ws", codes, "cs").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.w or "", r.c) for r in got) == [("", -1), ("b", 1), ("z", -1)]
    assert {r.id: r.cs for r in coded} == {1: [0, 2], 2: [], 3: [-1, 1], 4: [], 5: [-1, 0]}


# -- statistics -------------------------------------------------------------
def test_skewness(fact, frame, spark):
    assert fact.agg(S.adjusted_skewness(F.col("cost"))).first()[0] == pytest.approx(frame["cost"].skew())
    small = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert small.agg(S.adjusted_skewness(F.col("x"))).first()[0] == pytest.approx(1.763632, abs=1e-6)
    assert small.limit(2).agg(S.adjusted_skewness(F.col("x"))).first()[0] is None


def test_correlations(fact, frame):
    known = frame[frame.credible & frame.cost.notna()]
    got = one(measures.correlations(fact))
    assert got["pearson_cost"] == pytest.approx(known.cost.corr(known.rating))
    assert got["pearson_votes"] == pytest.approx(np.log1p(known.votes).corr(known.rating))
    assert got["n"] == len(known)
    rho = one(measures.spearman(fact))
    assert rho["spearman"] == pytest.approx(known.cost.rank().corr(known.rating.rank()))
    assert rho["n"] == len(known)


def test_correlations_without_spread_or_rows(fact, empty):
    flat = fact.withColumn("cost", F.lit(5.0))
    assert one(measures.correlations(flat))["pearson_cost"] is None
    assert one(measures.spearman(flat))["spearman"] is None
    assert one(measures.correlations(empty)) == {"pearson_cost": None, "pearson_votes": None, "n": 0}
    assert one(measures.spearman(empty)) == {"spearman": None, "n": 0}


def test_welch(fact, frame):
    rated = frame[frame.is_rated]
    a, b = rated[rated.has_delivery].rating, rated[~rated.has_delivery].rating
    expected = (a.mean() - b.mean()) / math.sqrt(a.var() / len(a) + b.var() / len(b))
    got = one(measures.delivery_difference(fact))
    assert got["welch_t"] == pytest.approx(expected)
    assert (got["n_yes"], got["n_no"]) == (len(a), len(b))


# -- bands --------------------------------------------------------------------
def test_band_edges(spark):
    values = [-1.0, 0.0, 199.99, 200.0, 1999.0, 2000.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(C.band(F.col("x"), COST_BANDS)).collect()]
    assert got == [None, "< 200", "< 200", "200-500", "1000-2000", "2000+", "2000+", None]


def test_band_definitions_are_checked():
    with pytest.raises(ValueError):
        Bands(edges=(0, 1), labels=("a", "b"))
    with pytest.raises(ValueError):
        Bands(edges=(0, None, 2), labels=("a", "b"))


def test_histogram_keeps_empty_bands(fact, frame, empty):
    got = {r.band: r.restaurants for r in measures.rating_histogram(fact).collect()}
    assert len(got) == 8 and got["1.0-1.5"] == 0 and sum(got.values()) == frame.is_rated.sum()
    assert [r.restaurants for r in measures.rating_histogram(empty).collect()] == [0] * 8


def test_trend(fact, frame):
    got = {r.band: (r.restaurants, r.avg_rating) for r in measures.cost_band_trend(fact).collect()}
    known = frame[frame.credible & frame.cost.notna()]
    assert got["800-1200"] == (0, None)
    assert got["<200"][0] == (known.cost < 200).sum()
    assert got["<200"][1] == pytest.approx(known[known.cost < 200].rating.mean())


def test_tiers_keep_empty_and_shares(fact, frame):
    got = {r.price_range: r for r in measures.tier_summary(fact, dict(PRICE_LABELS)).collect()}
    assert got[4].restaurants == 0 and got[4].avg_rating is None
    assert got[1].share_pct == pytest.approx(100 * (frame.price_range == 1).mean())
    observed = measures.tier_summary(fact, dict(PRICE_LABELS), keep_empty=False)
    assert [r.price_range for r in observed.collect()] == [1, 2, 3]


def test_published_tier_shares(spark):
    sizes = {1: 4295, 2: 2858, 3: 1111, 4: 388}
    sized = dimensions.code_table(spark, {t: str(n) for t, n in sizes.items()}, "price_range", "n")
    venues = sized.select("price_range", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("venue_id"))
    fact = venues.select(
        "venue_id",
        C.lookup(F.col("price_range"), PRICE_LABELS).alias("price_label"),
        *[F.lit(None).cast(k).alias(c) for c, k in
          [("rating", "double"), ("cost", "double"), ("has_delivery", "boolean"),
           ("has_booking", "boolean"), ("votes", "long")]],
    )
    got = measures.tier_summary(fact, dict(PRICE_LABELS)).select(F.round("share_pct", 1)).collect()
    assert [r[0] for r in got] == [49.6, 33.0, 12.8, 4.5]


# -- headline figures ---------------------------------------------------------
def test_kpis(fact, frame):
    got = one(measures.kpis(fact))
    assert got["restaurants"] == len(frame)
    assert got["cities"] == frame.city.nunique() and got["localities"] == frame.locality.nunique()
    assert got["avg_cost"] == pytest.approx(frame.cost.mean())
    assert got["median_cost"] == pytest.approx(frame.cost.median())
    assert got["p90_cost"] == pytest.approx(frame.cost.quantile(0.9))
    assert got["avg_rating"] == pytest.approx(frame.rating.mean())
    assert got["not_rated_pct"] == pytest.approx(100 * (~frame.is_rated).mean())
    assert got["delivery_pct"] == pytest.approx(100 * frame.has_delivery.mean())
    assert got["avg_cuisines"] == pytest.approx(frame.cuisine_count.mean())
    assert got["total_votes"] == frame.votes.sum() and got["cuisines"] == 5
    best = frame[frame.credible].sort_values(["rating", "votes", "venue_id"], ascending=[False, False, True]).iloc[0]
    assert (got["top_name"], got["top_rating"]) == (best.venue_name, best.rating)
    assert got["priciest_name"] == frame.sort_values(["cost", "venue_id"], ascending=[False, True]).iloc[0].venue_name


def test_kpis_of_nothing(empty):
    got = one(measures.kpis(empty))
    zero = {
        "restaurants", "cities", "localities", "rated_n", "not_rated_n", "total_votes", "cuisines", "credible_n",
    }
    assert {k for k, v in got.items() if v == 0} == zero
    assert all(v is None for k, v in got.items() if k not in zero)


def test_cuisines_fan_out_once(fact, frame):
    long = frame.explode("cuisine_list")
    expected = long.groupby("cuisine_list").venue_id.nunique().to_dict()
    assert {r.cuisine: r.restaurants for r in measures.cuisine_summary(fact).collect()} == expected
    pairs = fact.select("venue_id", F.explode("cuisine_list").alias("cuisine"))
    joined = measures.per_cuisine(measures.bridge_with_fact(pairs, fact))
    assert {r.cuisine: r.restaurants for r in joined.collect()} == expected


def test_top_share_is_of_the_filtered_rows(fact, frame):
    kept = frame[frame.city == "Hot City"]
    counts = kept.explode("cuisine_list").groupby("cuisine_list").size()
    top = sorted(counts.index, key=lambda c: (-counts[c], c))[:3]
    share = 100 * kept.cuisine_list.map(lambda kinds: bool(set(kinds) & set(top))).mean()
    got = one(measures.top_cuisine_share(filters.apply_filters(fact, FilterSpec(cities=("Hot City",)))))
    assert got["cuisines"] == ", ".join(sorted(top)) and got["share_pct"] == pytest.approx(share)


def test_city_floor_and_order(fact, frame):
    got = measures.city_benchmark(fact, 100).collect()
    sizes = frame.city.value_counts()
    assert {r.city for r in got} == set(sizes[sizes >= 100].index)
    assert got[0].city == "Hot City"
    assert [r.restaurants for r in got] == sorted((r.restaurants for r in got), reverse=True)


# -- filters ------------------------------------------------------------------
@pytest.mark.parametrize(
    "spec, mask",
    [
        (FilterSpec(), lambda d: d.venue_id >= 0),
        (FilterSpec(cities=("Hot City", "City 1")), lambda d: d.city.isin(["Hot City", "City 1"])),
        (FilterSpec(cuisines=("Thai", "Cafe")), lambda d: d.cuisine_list.map(lambda k: bool({"Thai", "Cafe"} & set(k)))),
        (FilterSpec(price_tiers=(2,)), lambda d: d.price_range == 2),
        (FilterSpec(min_rating=4.0), lambda d: d.rating >= 4.0),
        (FilterSpec(delivery_only=True, booking_only=True), lambda d: d.has_delivery & d.has_booking),
        (FilterSpec(rated_only=True, credible_only=True), lambda d: d.credible),
        (FilterSpec(search=" hot CITY l2 "), lambda d: d.locality == "Hot City L2"),
        (FilterSpec(search="v1.*"), lambda d: d.venue_id < 0),
        (FilterSpec(cities=("Hot City",), min_rating=4.99, price_tiers=(4,)), lambda d: d.venue_id < 0),
    ],
)
def test_filters(fact, frame, spec, mask):
    got = {r.venue_id for r in filters.apply_filters(fact, spec).select("venue_id").collect()}
    assert got == set(frame[mask(frame)].venue_id)
    line = filters.scope_line(fact, spec).first()
    assert (line.in_scope, line.total) == (len(got), len(frame))


# -- leaderboards and ranks -------------------------------------------------------
def test_name_ranks(fact, frame):
    names = frame.groupby("venue_name").agg(cost=("cost", "mean"), rating=("rating", "mean"), c=("credible", "sum"))
    names = names.round(9)
    cost = names.cost.rank(method="dense", ascending=False)
    rating = names.rating.rank(method="dense", ascending=False).where(names.c > 0)
    got = {r.venue_name: r for r in ranking.name_ranks(fact).collect()}
    assert set(got) == set(names.index)
    for name, row in got.items():
        assert row.cost_rank == (None if pd.isna(cost[name]) else cost[name])
        assert row.rating_rank == (None if pd.isna(rating[name]) else rating[name])


def test_best_value_floor(fact, frame):
    got = ranking.best_value(fact, 10).collect()
    assert all(r.rating >= 4.0 and r.votes >= 50 for r in got)
    good = frame[frame.credible & (frame.rating >= 4.0) & (frame.cost > 0)]
    best = (good.rating / (good.cost / 100)).nlargest(10)
    assert [r.stars_per_100 for r in got] == pytest.approx(list(best))


def test_sample_is_the_same_on_any_layout(fact):
    few = ranking.seeded_sample(fact.select("venue_id"), 50)
    again = ranking.seeded_sample(fact.repartition(13).select("venue_id"), 50)
    other = ranking.seeded_sample(fact.select("venue_id"), 50, seed=1)
    assert few.collect() == again.collect() and few.count() == 50
    assert set(few.collect()) != set(other.collect())
    assert ranking.seeded_sample(fact, 10_000).count() == fact.count()


# -- opportunity ------------------------------------------------------------------
def scores(frame, floor, keep_unrated=False):
    g = frame.groupby(["city", "locality"]).agg(n=("venue_id", "nunique"), r=("rating", "mean"), v=("votes", "sum"))
    g = g[g.n >= floor] if keep_unrated else g[(g.n >= floor) & g.r.notna()]
    demand = np.log1p(g.v / g.n)
    return ((demand - demand.mean()) / demand.std(ddof=0) - (g.r - g.r.mean()) / g.r.std(ddof=0)).to_dict()


@pytest.mark.parametrize("spec", [FilterSpec(), FilterSpec(delivery_only=True)])
def test_scores_move_with_the_filter(fact, frame, spec):
    kept = frame[frame.has_delivery] if spec.delivery_only else frame
    got = opportunity.opportunity(filters.apply_filters(fact, spec), 15).collect()
    assert {(r.city, r.locality): r.score for r in got} == pytest.approx(scores(kept, 15))


def test_scores_need_three_localities_and_a_spread(spark, fact):
    two = fact.where(F.col("locality").isin("Hot City L1", "Hot City L2"))
    assert [r.score for r in opportunity.opportunity(two, 1).collect()] == [None, None]
    same = spark.createDataFrame(
        [("c", f"l{i}", 20, 3.0, 100.0, 40, 2.0) for i in range(4)],
        "city string, locality string, restaurants int, avg_rating double, avg_cost double, "
        "total_votes int, votes_per_venue double",
    )
    assert [r.score for r in opportunity.score(same).collect()] == [0.0] * 4


def test_unrated_localities(spark):
    table = spark.createDataFrame(
        [("c", f"l{i}", 20, r, 100.0, 20 * v, float(v)) for i, (r, v) in enumerate([(3.0, 5), (4.0, 9), (2.5, 1), (None, 70)])],
        "city string, locality string, restaurants int, avg_rating double, avg_cost double, "
        "total_votes int, votes_per_venue double",
    )
    dropped = {r.locality: r.score for r in opportunity.score(table).collect()}
    kept = {r.locality: r.score for r in opportunity.score(table, keep_unrated=True).collect()}
    assert set(dropped) == {"l0", "l1", "l2"} and kept["l3"] is None
    assert dropped["l0"] != pytest.approx(kept["l0"])


def test_published_scores(spark):
    """Two z-scores and their difference, as published for the top locality."""
    row = spark.createDataFrame([(0.5226484946480247, -1.6162199229265424)], "demand_z double, quality_z double")
    assert row.select(F.round(F.col("demand_z") - F.col("quality_z"), 3)).first()[0] == 2.139


def test_shortlist(fact, frame):
    expected = sorted(scores(frame, 15).items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:12]
    got = sorted(opportunity.shortlist(opportunity.opportunity(fact, 15)).collect(), key=lambda r: -r.score)
    assert [(r.city, r.locality) for r in got] == [key for key, _ in expected]
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5] + [None] * (len(got) - 5)


# -- reconciliation ---------------------------------------------------------------
def test_reconcile(spark):
    schema = "metric string, number double, text string"
    actual = spark.createDataFrame(
        [("same", 1.0, None), ("close", 1.0, None), ("far", 1.0, None), ("blank", None, None),
         ("half", None, None), ("word", None, "a"), ("other", None, "a"), ("alone", 2.0, None)], schema
    )
    expected = spark.createDataFrame(
        [("same", 1.0, None), ("close", 1.05, None), ("far", 1.2, None), ("blank", None, None),
         ("half", 1.0, None), ("word", None, "a"), ("other", None, "b"), ("extra", 3.0, None)], schema
    )
    got = checks.reconcile(actual, expected, {"close": 0.1, "far": 0.1}).collect()
    assert {r.metric: r.passed for r in got} == {
        "same": True, "close": True, "far": False, "blank": True, "half": False,
        "word": True, "other": False, "alone": False, "extra": False,
    }


def test_checks_catch_a_lost_rule(fact):
    from venuelens.config import Floors

    good = checks.invariants(fact, Floors(), PRICE_LABELS)
    assert all(r.passed for r in good.collect())
    zeros = fact.withColumn("rating", F.coalesce("rating", F.lit(0.0)))
    failed = {r.check for r in checks.invariants(zeros, Floors(), PRICE_LABELS).collect() if not r.passed}
    assert failed == {"no rating of 0 is left"}
    mixed = fact.withColumn("currency", F.when(F.col("venue_id") < 5, "Dollar($)").otherwise(F.col("currency")))
    failed = {r.check for r in checks.invariants(mixed, Floors(), PRICE_LABELS).collect() if not r.passed}
    assert failed == {"a country has one currency"}
    none = checks.filter_invariants(fact, "Hot City", FilterSpec(min_rating=4.99, price_tiers=(4,)))
    assert checks.all_passed(none).first().failed == 0


def test_filter_checks_fail_when_a_filter_lets_rows_through(fact, monkeypatch):
    """Each filter that keeps what it should not is seen."""
    from venuelens.operators import filters

    monkeypatch.setattr(filters, "apply_filters", lambda df, spec: df)
    got = checks.filter_invariants(fact, "Hot City", FilterSpec(min_rating=4.99, price_tiers=(4,)), tiers=(1,))
    failed = {r.check for r in got.collect() if not r.passed}
    assert failed >= {
        "a city filter narrows the frame", "a city filter keeps only that city", "a tier filter keeps only those tiers",
        "an impossible filter is empty", "a flag filter keeps the flagged rows", "figures compute on an empty frame",
        "figures compute on a filtered frame",
    }
