"""The nested document and the packed rows."""

import json

import pytest

from venuelens.config import CleaningRules
from venuelens.operators import filters
from venuelens.sources import document, packed

from test_measures import fact, frame, rows  # noqa: F401


def test_document(fact, frame, tmp_path, spark):
    rules = CleaningRules()
    nested = document.kpi_document(fact, rules)
    path = str(tmp_path / "out")
    document.write_document(nested, document.growing_charts(fact, rules), path)
    lines = spark.read.text(f"{path}/kpis").collect()
    assert len(lines) == 1
    parsed = json.loads(lines[0].value)
    assert set(parsed) == {"meta", "kpi", "charts", "tables", "stats"}
    assert parsed["meta"]["rows"] == len(frame)
    assert parsed["kpi"]["avg_rating"] == pytest.approx(round(frame.rating.mean(), 2))
    assert parsed["kpi"]["bias_avoided"] == pytest.approx(
        round(parsed["kpi"]["avg_rating"] - parsed["kpi"]["naive_rating"], 2)
    )
    trend = parsed["charts"]["cost_band_rating_trend"]
    assert [t["band"] for t in trend][:2] == ["<200", "200-400"]
    assert trend[4] == {"band": "800-1200", "avg_rating": None, "restaurants": 0}
    assert len(parsed["tables"]["top_rated"]) == 15
    ratings = [r["rating"] for r in parsed["tables"]["top_rated"]]
    assert ratings == sorted(ratings, reverse=True)
    costs = [r["cost"] for r in parsed["tables"]["most_expensive"]]
    assert costs == sorted(costs, reverse=True) and None not in costs
    votes = [r["votes"] for r in parsed["tables"]["most_voted"]]
    assert votes == sorted(votes, reverse=True)
    assert len(parsed["charts"]["cost_vs_rating"]) <= 700
    assert parsed["charts"]["cuisine_by_volume"][0]["restaurants"] >= parsed["charts"]["cuisine_by_volume"][1]["restaurants"]
    cities = spark.read.json(f"{path}/charts/city_benchmark")
    assert {r.city for r in cities.collect()} == set(frame.city)


def test_packed(fact, frame, tmp_path, spark):
    result = packed.packed_rows(filters.in_country(fact, "India"))
    packed.write_packed(result, str(tmp_path / "packed"))
    back = spark.read.json(str(tmp_path / "packed" / "rows"))
    assert back.count() == len(frame)
    cities = {r.city: r.code for r in result.cities.collect()}
    assert [c for c, _ in sorted(cities.items(), key=lambda kv: kv[1])] == sorted(set(frame.city))
    cuisines = {r.code: r.cuisine for r in result.cuisines.collect()}
    expected = sorted((r.venue_name, cities[r.city], sorted(r.cuisine_list)) for r in frame.itertuples())
    got = sorted((r.name, r.city_code, [cuisines[c] for c in r.cuisine_codes]) for r in back.collect())
    assert got == expected
