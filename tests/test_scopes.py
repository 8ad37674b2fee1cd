"""One scope reduced once, many contexts at once, and the layout by venue."""

import math
import re

import pytest
from harness import spark_result
from pyspark.sql import functions as F

from venuelens.config import Bands
from venuelens.operators import contexts, filters, measures, opportunity, ranking, rollup
from venuelens.plans import registry
from venuelens.sources import driver_tables as tables
from venuelens.sources import star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def home(spark):
    return registry.home(spark, SF_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b, tolerance=1e-9):
    """Equal rows, doubles within a relative tolerance."""
    (names, rows), (others, wanted) = spark_result(a), spark_result(b)
    assert names == others and len(rows) == len(wanted)
    for row, want in zip(rows, wanted, strict=True):
        for x, y in zip(row, want, strict=True):
            close = isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=tolerance, abs_tol=1e-9)
            assert close or x == y, (row, want)


# -- one scope --------------------------------------------------------------
@pytest.fixture(scope="module")
def scope(home):
    return rollup.summarise(home, ranking.standard_boards(registry.MAX_POINT_COST), trend_bands=tables.TREND_BANDS)


def test_tables_of_a_summary_equal_the_measures(home, scope):
    same(scope.kpis(), measures.kpis(home))
    same(scope.localities(3), opportunity.locality_totals(home, 3))
    same(scope.spearman(), measures.spearman(home))
    same(scope.top_cuisine_share(), measures.top_cuisine_share(home))


def test_boards_equal_their_own_queries(home, scope):
    queries = {
        "top_rated": ranking.top_rated, "most_expensive": ranking.most_expensive, "best_value": ranking.best_value,
        "most_voted": ranking.most_voted,
    }
    for name, query in queries.items():
        got = [r.venue_id for r in scope.boards.where(F.col("board") == name).orderBy("place").collect()]
        assert got == [r.venue_id for r in query(home).collect()] and 0 < len(got) <= 15
    points = ranking.seeded_sample(ranking.scatter_points(home, registry.MAX_POINT_COST))
    got = scope.boards.where("board = 'cost_vs_rating'").select("venue_id")
    assert sorted(r.venue_id for r in got.collect()) == sorted(r.venue_id for r in points.collect())


def test_an_empty_scope_has_a_summary(home):
    nothing = rollup.summarise(home.where("venue_id < 0"), ranking.standard_boards(1.0))
    same(nothing.kpis(), measures.kpis(home.where("venue_id < 0")))
    assert nothing.spearman().first().asDict() == {"spearman": None, "n": 0}


def test_the_document_scans_the_fact_eight_times(spark, monkeypatch):
    """Counted over the jobs that write the summary and over the query itself."""
    scans, write = [], rollup.written

    def counted(df, name):
        scans.append((name, plan(df).count("venuelens-star-")))
        return write(df, name)

    monkeypatch.setattr(rollup, "written", counted)
    nested = registry._document(spark, SF_DIR)
    assert dict(scans) == {"cells": 1, "values": 1, "cuisines": 1, "places": 1, "boards": 1, "ranks": 0}
    text = plan(nested)
    # A subquery that several columns read is printed once and run once.
    own = {block.split("\n")[0] for block in re.findall(r"FileScan[^\n]*venuelens-star-[^\n]*", text)}
    assert 1 <= len(own) <= 3
    assert "SortAggregate" not in plan(measures.area_totals(registry.home(spark, SF_DIR)))


# -- many contexts ----------------------------------------------------------
def test_strips_of_contexts_equal_one_at_a_time(home):
    got = {r.name: r.asDict() for r in contexts.kpi_strips(home, registry.CONTEXTS).collect()}
    assert list(got) == list(registry.CONTEXTS) or sorted(got) == sorted(registry.CONTEXTS)
    for name, spec in registry.CONTEXTS.items():
        want = measures.kpis(filters.apply_filters(home, spec)).first().asDict()
        for figure, value in want.items():
            assert got[name][figure] == (pytest.approx(value) if isinstance(value, float) else value), (name, figure)
    assert got["impossible"]["restaurants"] == 0 and got["impossible"]["avg_cost"] is None


def test_scope_lines_equal_one_at_a_time(home):
    got = {r.name: (r.in_scope, r.total) for r in contexts.scope_lines(home, registry.CONTEXTS).collect()}
    assert got == {n: tuple(filters.scope_line(home, s).first()) for n, s in registry.CONTEXTS.items()}


def test_contexts_cost_four_scans_however_many(spark, home, monkeypatch):
    from venuelens.operators import ordering

    eager, write = [], ordering.written
    monkeypatch.setattr(ordering, "written", lambda df, name: eager.append(plan(df).count("venuelens-star-")) or write(df, name))
    text = plan(contexts.kpi_strips(home, registry.CONTEXTS))
    assert sum(eager) == 1 and text.count("venuelens-star-") == 3
    assert plan(contexts.scope_lines(home, registry.CONTEXTS)).count("venuelens-star-") == 1


# -- by venue ---------------------------------------------------------------
def test_fact_and_bridge_meet_without_a_shuffle(spark):
    registry.by_venue(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("star_join", "home_bridge"):
            text = plan(registry.REGISTRY[name](spark, SF_DIR))
            join = re.search(r"\n([ :+|*()0-9-]*)SortMergeJoin \[venue_id", text)
            assert join, name
            below = []
            for line in text[join.end() :].split("\n")[1:]:
                if line and len(re.match(r"[ :+|-]*", line).group()) <= len(re.match(r"[ :+|-]*", join.group(1)).group()):
                    break
                below.append(line)
            assert below and not any("Exchange" in line for line in below), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_layout_by_venue_holds_the_star(spark):
    path = registry.built_star(spark, SF_DIR)
    stored = registry.by_venue(spark, SF_DIR)
    same(stored.bridge, star.read_table(spark, path, "bridge"))
    assert stored.fact.exceptAll(star.read_fact(spark, path)).count() == 0
    assert stored.fact.count() == star.read_fact(spark, path).count()


def test_the_layout_can_be_read_in_a_later_session(spark, tmp_path):
    path = star.write_star(registry.cleaned(spark, SF_DIR), f"{tmp_path}/s")
    wrote = star.write_by_venue(spark, path, least=4)
    rows = wrote.fact.count()
    for table in ("fact", "bridge"):
        spark.sql(f"DROP TABLE {star._bucketed_name(path, table)}")
    again = star.read_by_venue(spark, path, 4)
    assert again.fact.count() == rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(again.bridge.join(again.fact.select("venue_id"), "venue_id", "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_labels_with_marks_reach_the_document(spark):
    from venuelens.sources import document

    odd = Bands(edges=(0, 3, None), labels=("it's {under} \\", 'a "b"'))
    fact = registry.fact(spark, SF_DIR)
    row = document.kpi_document(fact, tables.RULES, trend_bands=odd, rating_bands=odd).first()
    assert [r.band for r in row.charts.rating_distribution] == list(odd.labels)
    rated = registry.home(spark, SF_DIR).where("is_rated").count()
    assert sum(r.restaurants for r in row.charts.rating_distribution) == rated
