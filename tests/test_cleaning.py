"""Each cleaning rule on hand-made raw rows, read from a latin-1 file."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from venuelens.config import CleaningRules
from venuelens.operators import cleaning
from venuelens.plans.batch import run
from venuelens.plans.pipeline import build, clean
from venuelens.schemas import FACT, RAW_HEADER
from venuelens.sources import star as stars
from venuelens.sources.raw import NULL_TOKENS, HeaderError, read_raw, write_raw
from venuelens.sources.star import aggregates, load_model, write_aggregates

RUPEES = "Indian Rupees(Rs.)"
DEFAULT = {
    "Restaurant ID": 0, "Restaurant Name": "Plain", "Country Code": 1, "City": "New Delhi",
    "Address": "1 Road", "Locality": "Centre", "Longitude": 77.2, "Latitude": 28.6,
    "Cuisines": "Chinese", "Average Cost for two": 500, "Currency": RUPEES,
    "Has Table booking": "No", "Has Online delivery": "Yes", "Is delivering now": "No",
    "Switch to order menu": "No", "Price range": 2, "Aggregate rating": 4.0,
    "Rating text": "Good", "Votes": 100,
}

CHANGES = [
    {"Restaurant Name": "  Caf\xe9 \xa0", "City": "\tNoida ", "Address": 'Shop 1, "The Mall"\nFloor 2'},
    {"Restaurant ID": 1, "Restaurant Name": "first"},
    {"Restaurant ID": 1, "Restaurant Name": "second", "Votes": 7},
    {"Country Code": 999},
    {"Has Table booking": "YES", "Has Online delivery": "no", "Is delivering now": "maybe"},
    {"Has Table booking": "", "Aggregate rating": 0, "Rating text": "Poor"},
    {"Aggregate rating": "", "Rating text": "Poor"},
    {"Votes": 0},
    {"Votes": 49},
    {"Votes": 50},
    {"Average Cost for two": 0},
    {"Average Cost for two": -5},
    {"Average Cost for two": 199},
    {"Average Cost for two": 200},
    {"Average Cost for two": 2000},
    {"Cuisines": ""},
    {"Cuisines": "Thai, Chinese"},
    {"Cuisines": "Thai,,Chinese, Thai"},
    {"Cuisines": " , "},
    {"Latitude": 91},
    {"Latitude": 0, "Longitude": 0},
    {"Latitude": ""},
    {"Currency": "Dollar($)", "Country Code": 216, "Average Cost for two": 30},
    {"Restaurant Name": "NA"},
]


def rows():
    out = []
    for number, change in enumerate(CHANGES):
        out.append({**DEFAULT, "Restaurant ID": 100 + number, **change})
    return out


def write(path, records, header=None):
    header = header or [f" {name} " if name == "City" else name for name in RAW_HEADER]
    with open(path, "w", encoding="latin-1", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(["Extra", *header])
        for record in records:
            writer.writerow(["x", *[record[name.strip()] for name in header]])


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "extract.csv"
    write(path, rows())
    return read_raw(spark, str(path), multi_line=True)


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean(raw)


@pytest.fixture(scope="module")
def star(cleaned):
    return cleaned.star()


@pytest.fixture(scope="module")
def facts(star):
    return {row.venue_id: row for row in star.fact.collect()}


def test_header_contract(spark, tmp_path):
    path = tmp_path / "bad.csv"
    write(path, rows()[:1], header=[name for name in RAW_HEADER if name != "Average Cost for two"])
    with pytest.raises(HeaderError, match="Average Cost for two"):
        read_raw(spark, str(path))


def test_rows_and_types(raw, star):
    assert raw.count() == len(CHANGES)
    assert star.fact.schema.names == FACT.names
    assert [f.dataType for f in star.fact.schema] == [f.dataType for f in FACT]


def test_text_is_latin_1_trimmed_and_unquoted(facts):
    assert facts[100].venue_name == "Caf\xe9"
    assert facts[100].city == "Noida"
    assert facts[100].address == 'Shop 1, "The Mall"\nFloor 2'


def test_null_words(facts):
    assert facts[123].venue_name is None


def test_first_duplicate_wins(facts):
    assert facts[1].venue_name == "first" and facts[1].votes == 100
    assert len(facts) == len(CHANGES) - 1


def test_country(facts):
    assert facts[103].country == "Unknown"
    assert facts[122].country == "United States"
    assert facts[104].country == "India"


def test_flags(facts):
    assert (facts[104].has_booking, facts[104].has_delivery, facts[104].delivering_now) == (True, False, None)
    assert facts[105].has_booking is None


@pytest.mark.parametrize("venue", [105, 106])
def test_unrated(facts, venue):
    row = facts[venue]
    assert (row.rating, row.is_rated, row.rating_text, row.credible, row.value_score) == (
        None, False, "Not rated", False, None,
    )


def test_votes(facts):
    assert (facts[107].has_votes, facts[107].credible) == (False, False)
    assert not facts[108].credible
    assert facts[109].credible


def test_cost(facts):
    assert facts[110].cost is None and facts[111].cost is None
    assert [facts[i].cost_band for i in (110, 112, 113, 114)] == [None, "< 200", "200-500", "2000+"]
    assert facts[113].value_score == pytest.approx(2.0)
    assert facts[122].cost_band is None and facts[122].value_score is None and facts[122].cost == 30


def test_cuisines(facts, star):
    assert facts[115].cuisines == "Unspecified" and facts[115].cuisine_count == 1
    assert facts[117].cuisine_count == 3 and facts[117].cuisine_list == ["Thai", "Chinese"]
    assert facts[118].cuisine_count == 0
    pairs = {(row.venue_id, row.cuisine) for row in star.bridge.collect()}
    assert {c for v, c in pairs if v == 117} == {"Thai", "Chinese"}
    assert {c for v, c in pairs if v == 115} == {"Unspecified"}
    assert not {c for v, c in pairs if v == 118}


def test_geo(facts):
    assert [facts[i].geo_valid for i in (100, 119, 120, 121)] == [True, False, False, False]


def test_price_labels(facts):
    assert facts[100].price_label == "2 - Mid-range"


def test_quality_log(star):
    log = {row.step: row.rows_affected for row in star.quality_log.collect()}
    kept = len(CHANGES) - 1
    assert log == {
        "load": len(CHANGES), "dedupe": 1, "country_map": 1, "drop_constant": kept,
        "rating_zero_to_null": 1, "cost_zero_to_null": 2, "cuisine_missing": 1,
        "cuisine_explode": star.bridge.count(), "derived": kept, "geo_flag": 3,
    }


def test_drop_constants(spark):
    df = spark.createDataFrame([(1, True, None, False), (2, True, None, True)], "id int, a boolean, b boolean, c boolean")
    assert cleaning.drop_constants(df, ["a", "b", "c", "missing"]).columns == ["id", "c"]


def test_keep_first_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")).alias("key"), (-F.col("id")).alias("order")
    )
    kept = {row.key: row.order for row in cleaning.keep_first(df, "key", ["order"]).collect()}
    assert len(kept) == 20_001 and kept[-1] == -9_999


def test_source_order_over_file_splits(spark, tmp_path):
    records = [
        {**DEFAULT, "Restaurant ID": i % 700, "Restaurant Name": f"row {i}"} for i in range(3_000)
    ]
    for part in range(2):
        write(tmp_path / f"part-{part}.csv", records[part * 1_500 : (part + 1) * 1_500])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split, whole = read_raw(spark, str(tmp_path)), read_raw(spark, str(tmp_path), multi_line=True)
        assert split.select("_block").distinct().count() > 5
        assert whole.select("_block").distinct().count() == 1
        for raw in (split, whole):
            names = {r.venue_id: r.venue_name for r in clean(raw).star().fact.collect()}
            assert names == {i: f"row {i}" for i in range(700)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("column", ["Restaurant Name", "Address", "Votes"])
def test_a_cut_record_fails_the_split_read(spark, tmp_path, column):
    path = tmp_path / "extract.csv"
    write(path, [{**DEFAULT, "Restaurant ID": 1}, {**DEFAULT, "Restaurant ID": 2, column: "1\n2"}])
    assert read_raw(spark, str(path), multi_line=True).count() == 2
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_raw(spark, str(path)).select("venue_id").collect()


def test_counted_dedupe_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")).alias("key"), (-F.col("id")).alias("order")
    )
    kept = {row.key: row for row in cleaning.keep_first_counted(df, "key", ["order"], "n").collect()}
    assert len(kept) == 20_001 and (kept[-1].order, kept[-1].n) == (-9_999, 10_000)
    assert kept[10_000].n == 1


def test_star_on_disk(spark, raw, star, tmp_path):
    path = str(tmp_path / "star")
    back = build(raw, path)
    assert sorted(back.quality_log.collect()) == sorted(star.quality_log.collect())
    assert sorted(map(str, back.fact.collect())) == sorted(map(str, star.fact.collect()))
    assert sorted(back.bridge.collect()) == sorted(star.bridge.collect())
    assert back.dim_price_range.count() == 4
    assert back.quality_log.count() == 10
    assert {r.country for r in back.dim_country.collect()} == {"India", "Unknown", "United States"}
    fact, bridge = load_model(spark, path)
    assert fact.count() == len(CHANGES) - 3
    assert {r.venue_id for r in bridge.collect()} <= {r.venue_id for r in fact.collect()}

    tables = aggregates(fact, CleaningRules().price_labels)
    write_aggregates(tables, str(tmp_path / "agg"), csv=True)
    city = spark.read.parquet(str(tmp_path / "agg" / "agg_city_benchmark"))
    assert [(r.city, r.restaurants) for r in city.collect()] == [("New Delhi", len(CHANGES) - 4)]
    assert spark.read.option("header", True).csv(str(tmp_path / "agg" / "agg_cuisine_csv")).count() >= 2


def test_a_failed_write_leaves_the_old_star(spark, raw, star, tmp_path, monkeypatch):
    path = str(tmp_path / "star")
    old = build(raw, path)
    opened = stars.read_star(spark, path)
    broken = star.dim_country.withColumn("country", F.raise_error(F.lit("third table")))
    with monkeypatch.context() as patched:
        patched.setattr(stars.dimensions, "dim_country", lambda fact: broken)
        with pytest.raises(Exception, match="third table"):
            build(raw.where("venue_id > 110"), path)
    assert len(list((tmp_path / "star").glob("star-*"))) == 2
    assert len(stars.published(spark, path)) == 1
    for name in stars.TABLES:
        whole = sorted(map(str, getattr(star, name).collect()))
        for again in (old, opened, stars.read_star(spark, path)):
            assert sorted(map(str, getattr(again, name).collect())) == whole


def test_the_newest_star_counts_and_old_ones_retire(spark, raw, tmp_path):
    path = str(tmp_path / "star")
    assert stars.published(spark, path) == [] and stars.current(spark, path) == path
    first = build(raw, path)
    build(raw.where("venue_id > 105"), path)
    last = build(raw.where("venue_id > 110"), path)
    assert [number for number, _ in stars.published(spark, path)] == [3, 2, 1]
    assert stars.read_star(spark, path).fact.count() == last.fact.count() < first.fact.count()
    names = [name for _, name in stars.published(spark, path)]
    assert stars.retire(spark, path) == names[2:] and stars.retire(spark, path) == []
    assert stars.retire(spark, path, keep=0) == [names[1]]
    assert stars.read_star(spark, path).bridge.count() == last.bridge.count()
    assert sorted(p.name for p in (tmp_path / "star").glob("star-*")) == [names[0]]


def test_an_extract_comes_back_as_it_was(spark, raw, tmp_path):
    source = raw.drop("_file", "_block", "_row")
    columns = source.columns
    one_line = source.withColumn("address", F.translate("address", "\n", " "))
    ordered = one_line.orderBy("venue_id", F.desc("votes"))
    write_raw(ordered.repartitionByRange(3, "venue_id").sortWithinPartitions("venue_id", F.desc("votes")), str(tmp_path / "x"))
    back = read_raw(spark, str(tmp_path / "x"))
    assert back.select("_file").distinct().count() == 3
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, one_line.collect()))
    # The first copy in the files stays: the one with more votes.
    kept = {r.venue_id: r for r in clean(back).audited.collect()}
    assert (kept[1].venue_name, kept[1].votes, kept[1].copies) == ("first", 100, 2)


def test_an_extract_with_gaps_breaks_and_no_rows(spark, raw, tmp_path):
    source = raw.drop("_file", "_block", "_row").limit(1)
    odd = source.withColumns({"venue_name": F.lit("\u4e2d"), "city": F.lit(NULL_TOKENS[1]), "cost": F.lit(None).cast("double"),
                              "address": F.lit('a "b",\nc')})
    write_raw(odd, str(tmp_path / "odd"))
    row = read_raw(spark, str(tmp_path / "odd"), multi_line=True).first()
    assert (row.venue_name, row.city, row.cost, row.address) == ("?", None, None, 'a "b",\nc')
    write_raw(source.where("false"), str(tmp_path / "none"))
    assert read_raw(spark, str(tmp_path / "none")).count() == 0


def test_batch_run(spark, tmp_path):
    path = tmp_path / "extract.csv"
    write(path, rows())
    out = str(tmp_path / "out")
    model = run(spark, str(path), out, multi_line=True)
    assert model.fact.count() == len(CHANGES) - 1
    text = spark.read.text(f"{out}/document/kpis").first().value
    figures = json.loads(text)
    home = len(CHANGES) - 3
    assert figures["meta"]["rows_home"] == figures["kpi"]["restaurants"] == home
    assert figures["tables"]["opportunity"] == []
    assert spark.read.parquet(f"{out}/aggregates/agg_price_range").count() == 1
    assert spark.read.json(f"{out}/packed/rows").count() == home
    overview = spark.read.json(f"{out}/document/charts/country_overview")
    assert {r.country: r.restaurants for r in overview.collect()}["India"] == home
