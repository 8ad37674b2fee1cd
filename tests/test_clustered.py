"""The layout clustered for filters: the same rows, of which a filter reads fewer."""

import pytest
from harness import spark_result
from pyspark.sql import functions as F

from venuelens.config import FilterSpec
from venuelens.operators import filters
from venuelens.plans import registry
from venuelens.schemas import FACT
from venuelens.sources import clustered, star

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def path(spark):
    return registry.built_star(spark, SF_DIR)


@pytest.fixture(scope="module")
def laid(spark, path):
    # Small pages, so that these few rows have many.
    return clustered.write_clustered(spark, path, page_rows=25, least=2)


def rows_read(df):
    """Rows that came out of the scan after row groups and pages were passed over."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def in_asia(fact, test):
    return filters.in_country(fact, "ASIA").where(test).select("venue_id", "city", "locality", "price_range")


def test_the_clustered_fact_is_the_fact(spark, path, laid):
    assert spark_result(laid) == spark_result(star.read_fact(spark, path))


TESTS = {
    "city": "city = 'NATION_2'",
    "locality": "locality = 'BUILDING'",
    "tier": "price_range = 4",
}


@pytest.mark.parametrize("name", TESTS)
def test_a_filter_on_any_key_reads_little_more_than_its_rows(spark, path, laid, name):
    found = in_asia(laid, TESTS[name])
    rows, read, whole = found.count(), rows_read(found), in_asia(laid, "true").count()
    # A value holds a fifth of the rows: a page may begin and end with other values.
    assert 0 < rows <= read < 0.65 * whole
    assert spark_result(found) == spark_result(in_asia(star.read_fact(spark, path), TESTS[name]))


def test_rows_read_fall_with_the_selectivity(laid):
    names = ["locality", "city", "tier"]
    tests = [" AND ".join(["true"] + [TESTS[n] for n in names[:i]]) for i in range(4)]
    read = [rows_read(in_asia(laid, test)) for test in tests]
    assert read == sorted(read, reverse=True) and len(set(read)) == 4 and read[3] < read[0] / 10


def test_a_venue_is_looked_up_through_statistics_and_bloom_filters(laid):
    home = filters.in_country(laid, "ASIA")
    known = home.agg(F.max("venue_id")).first()[0]
    found = filters.by_ids(home, [known])
    assert [r.venue_id for r in found.collect()] == [known]
    assert rows_read(found.select("venue_id", "venue_name")) < home.count() / 3
    # An id between two that occur lies within the extremes of a group, which only its bloom filter rules out.
    ids = {r.venue_id for r in home.select("venue_id").collect()}
    missing = next(i for i in range(known // 2, known) if i not in ids)
    assert rows_read(filters.by_ids(home, [missing]).select("venue_id", "venue_name")) == 0
    assert filters.by_ids(home, []).count() == 0


def test_bloom_filters_are_written(spark, laid):
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(next(f for f in laid.inputFiles() if "ASIA" in f))
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
    finally:
        reader.close()
    # Localities of few values lie in a dictionary, which does the same.
    assert offsets["venue_id"] > 0 and offsets["votes"] < 0


def test_ranges_and_interleaved_bits(spark):
    values = ["", "a", "b", "bb", "m", "z", None]
    starts = ["b", "m"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    number, bits = clustered.range_number(F.col("v"), starts)
    # Three ranges over the numbers 0 to 3.
    assert bits == 2 and [r[0] for r in df.select(number).collect()] == [0, 0, 1, 1, 2, 2, 2]
    number, bits = clustered.range_number(F.col("v"), ["a", "b", "c", "m"])
    assert bits == 3 and [r[0] for r in df.select(number).collect()] == [0, 1, 3, 3, 6, 6, 6]
    number, bits = clustered.range_number(F.col("v"), [])
    assert bits == 0 and {r[0] for r in df.select(number).collect()} == {0}
    df = spark.createDataFrame([(c, l, t) for c in range(4) for l in range(4) for t in range(2)], "c int, l int, t int")
    key = clustered.interleaved([(F.col("c"), 2), (F.col("l"), 2), (F.col("t"), 1)])
    rows = df.select("c", "l", "t", key.alias("key")).collect()
    assert sorted(r.key for r in rows) == list(range(32))
    for r in rows:
        assert f"{r.key:05b}" == f"{r.c >> 1}{r.l >> 1}{r.t}{r.c & 1}{r.l & 1}"


def test_ranges_of_many_values_and_of_none(spark):
    df = spark.range(5_000).select(F.format_string("p%05d", "id").alias("locality"))
    starts = clustered.range_starts(df, "locality", 64)
    assert 40 <= len(starts) <= 63 and starts == sorted(set(starts))
    numbered = df.groupBy(clustered.range_number(F.col("locality"), starts)[0].alias("n")).count().collect()
    assert max(r["count"] for r in numbered) < 400
    assert clustered.range_starts(df.where("false"), "locality", 64) == []


def test_a_hot_cell_is_split_over_files(spark, path, tmp_path):
    fact = star.read_fact(spark, path)
    same = {"city": F.lit("X"), "locality": F.lit("Y"), "price_range": F.lit(1), "country": F.lit("ASIA")}
    fact.withColumns(same).write.partitionBy("country").parquet(f"{tmp_path}/fact")
    laid = clustered.write_clustered(spark, str(tmp_path), least=4)
    sizes = [r["count"] for r in laid.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.4 * sum(sizes)


def test_a_task_sorts_a_bounded_number_of_rows(spark, tmp_path):
    empty = {f.name: F.lit(None).cast(f.dataType) for f in FACT if f.name not in ("venue_id", "country")}
    rows = spark.range(600_000).select(F.col("id").alias("venue_id"), F.lit("ASIA").alias("country"))
    rows.withColumns(empty).select(*FACT.names).write.partitionBy("country").parquet(f"{tmp_path}/fact")
    laid = clustered.write_clustered(spark, str(tmp_path), least=1)
    sizes = [r["count"] for r in laid.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 600_000 and max(sizes) < 350_000


def test_filters_give_the_same_on_both_layouts(spark, path, laid):
    for spec in (registry.COMBINED, registry.IMPOSSIBLE, FilterSpec(search="building"), FilterSpec(price_tiers=(1, 4))):
        got, want = (
            spark_result(filters.apply_filters(filters.in_country(f, "ASIA"), spec).select("venue_id", "rating"))
            for f in (laid, star.read_fact(spark, path))
        )
        assert got == want
