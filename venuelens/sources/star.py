"""The star schema on disk: Parquet between cleaning and analysis.

Every run writes its tables into a folder of its own, and only when all five are whole does one row in
``versions`` publish that folder. A run that fails half way leaves the star before it untouched, and
whoever opened that one goes on reading it.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.config import CleaningRules, Floors, Scope
from venuelens.operators import cleaning, dimensions, filters, measures, opportunity
from venuelens.schemas import AUDITED, BRIDGE, DIM_COUNTRY, DIM_PRICE_RANGE, FACT, QUALITY_LOG

TABLES = {
    "fact": FACT,
    "bridge": BRIDGE,
    "dim_country": DIM_COUNTRY,
    "dim_price_range": DIM_PRICE_RANGE,
    "quality_log": QUALITY_LOG,
}

VERSIONS = T.StructType([T.StructField("number", T.LongType()), T.StructField("folder", T.StringType())])


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    bridge: DataFrame
    dim_country: DataFrame
    dim_price_range: DataFrame
    quality_log: DataFrame


@dataclass(frozen=True)
class Cleaned:
    """Cleaned rows with their audit columns: all five tables follow from them. ``prepared`` are the
    same rows before the rules that look at one row only."""

    audited: DataFrame
    rules: CleaningRules
    raw_columns: int
    prepared: DataFrame

    def star(self) -> Star:
        fact = self.audited.select(*FACT.names)
        return Star(
            fact=fact,
            bridge=cleaning.bridge(fact),
            dim_country=dimensions.dim_country(fact),
            dim_price_range=dimensions.dim_price_range(fact.sparkSession, self.rules.price_labels),
            quality_log=cleaning.quality_log(self.audited, self.rules, self.raw_columns),
        )


def cleaned_from(prepared: DataFrame, rules: CleaningRules, raw_columns: int) -> Cleaned:
    return Cleaned(cleaning.clean_rows(prepared, rules), rules, raw_columns, prepared)


def laid_out(cleaned: Cleaned) -> DataFrame:
    """The audited rows as they are written: by country, so that a country scope prunes directories.

    Rebalancing by country gathers the rows of a small country into few files and
    splits a country that holds most of the rows over many tasks. Inside a file rows lie
    by city and locality, so that filters on them skip Parquet pages; the write sorts by
    country in any case. What the rules derive from one row (lists, bands, labels, audit) is
    derived behind the shuffle and the sort, which would else carry it; the sort keys stay as they are.
    """
    balanced = cleaned.prepared.hint("rebalance", "country").sortWithinPartitions("country", "city", "locality")
    return cleaning.clean_rows(balanced, cleaned.rules)


def write_fact(cleaned: Cleaned, path: str) -> None:
    laid_out(cleaned).write.mode("overwrite").partitionBy("country").parquet(f"{path}/fact")


def read_audited(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDITED).parquet(f"{path}/fact").select(*AUDITED.names)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT).parquet(f"{path}/fact").select(*FACT.names)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    if table == "fact":
        return read_fact(spark, path)
    return spark.read.schema(TABLES[table]).parquet(f"{path}/{table}")


def published(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder name of the stars published under ``path``, the newest first."""
    try:
        versions = spark.read.schema(VERSIONS).parquet(f"{path}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    # One row per run.
    return sorted(((row.number, row.folder) for row in versions.collect()), reverse=True)


def current(spark: SparkSession, path: str) -> str:
    """Folder of the newest whole star under ``path``, or ``path`` itself where it is such a folder."""
    found = published(spark, path)
    return f"{path}/{found[0][1]}" if found else path


def begin_star(cleaned: Cleaned, path: str) -> str:
    """Clean the raw rows, read once, into the fact of a new folder under ``path``, which is returned. Not
    published yet: ``finish_star`` does that."""
    folder = f"{path}/star-{uuid.uuid4().hex}"
    write_fact(cleaned, folder)
    return folder


def finish_star(cleaned: Cleaned, folder: str) -> None:
    """The other tables of a folder that ``begin_star`` began, the quality log included, from the fact that was
    written. The folder is published last, by one file."""
    spark = cleaned.audited.sparkSession
    path, _, name = folder.rpartition("/")
    written = replace(cleaned, audited=read_audited(spark, folder)).star()
    for table in TABLES:
        if table != "fact":
            getattr(written, table).write.mode("overwrite").parquet(f"{folder}/{table}")
    number = max([n for n, _ in published(spark, path)], default=0) + 1
    # Of two runs that end together both are published, and the larger name is the newer one.
    row = spark.range(0, 1, 1, 1).select(F.lit(number).cast("long").alias("number"), F.lit(name).alias("folder"))
    row.write.mode("append").parquet(f"{path}/versions")


def write_star(cleaned: Cleaned, path: str) -> str:
    """All five tables in a new folder under ``path``, which is returned."""
    folder = begin_star(cleaned, path)
    finish_star(cleaned, folder)
    return folder


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the published stars but the newest ``keep``, one at least, and name those deleted.

    For when nobody reads them any more; the rows that published them stay, as the newest one counts.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    gone = []
    for _, name in published(spark, path)[max(keep, 1):]:
        folder = hadoop(f"{path}/{name}")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True):
            gone.append(name)
    return gone


# Rows of the fact in a bucket of the layout by venue, and buckets at most.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 16_384


@dataclass(frozen=True)
class ByVenue:
    """Fact and bridge, each in the same number of buckets by venue id: they join without a shuffle."""

    fact: DataFrame
    bridge: DataFrame


def _bucketed_name(path: str, table: str) -> str:
    return f"venuelens_{hashlib.md5(path.encode()).hexdigest()}_{table}"


def write_by_venue(spark: SparkSession, path: str, least: int = 8) -> ByVenue:
    """Write the star's fact and bridge once more, in buckets of the venue id, and read them.

    A layout for those who join the two often: the shuffle is paid at the write. Buckets follow the size
    of the fact. A venue is in the fact once and has few cuisines, so no bucket is hot.
    """
    rows = read_fact(spark, path).count()
    buckets = min(MOST_BUCKETS, max(least, 1 << (-(-rows // BUCKET_ROWS) - 1).bit_length()))
    for table in ("fact", "bridge"):
        dealt = read_table(spark, path, table).repartition(buckets, "venue_id")
        # One file for each bucket, as the rows are dealt by the same hash.
        writer = dealt.write.mode("overwrite").bucketBy(buckets, "venue_id").sortBy("venue_id")
        spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(path, table)}")
        writer.option("path", f"{path}/by_venue/{buckets}/{table}").saveAsTable(_bucketed_name(path, table))
    return read_by_venue(spark, path, buckets)


def read_by_venue(spark: SparkSession, path: str, buckets: int) -> ByVenue:
    """The layout by venue that ``write_by_venue`` wrote in so many buckets, in this or an earlier session."""
    for table in ("fact", "bridge"):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[table])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_bucketed_name(path, table)} ({fields}) USING parquet"
            f" CLUSTERED BY (venue_id) SORTED BY (venue_id) INTO {buckets} BUCKETS"
            f" LOCATION '{path}/by_venue/{buckets}/{table}'"
        )
    return ByVenue(**{t: spark.table(_bucketed_name(path, t)).select(*TABLES[t].names) for t in ("fact", "bridge")})


def read_star(spark: SparkSession, path: str) -> Star:
    """The newest whole star under ``path``."""
    folder = current(spark, path)
    return Star(**{name: read_table(spark, folder, name) for name in TABLES})


def load_model(spark: SparkSession, path: str, scope: Scope = Scope()) -> tuple[DataFrame, DataFrame]:
    """Fact and bridge of the home country, from the newest whole star under ``path``."""
    folder = current(spark, path)
    fact = filters.in_country(read_fact(spark, folder), scope.home_country)
    return fact, filters.restrict_bridge(read_table(spark, folder, "bridge"), fact)


def aggregates(
    fact: DataFrame, price_labels: dict[int, str], floors: Floors = Floors()
) -> dict[str, DataFrame]:
    """The four aggregate tables of a scoped fact."""
    return {
        "agg_city_benchmark": measures.city_summary(fact, floors.city),
        "agg_cuisine": measures.cuisine_summary(fact),
        "agg_locality_opportunity": opportunity.opportunity(fact, floors.locality, keep_unrated=True),
        "agg_price_range": measures.tier_summary(fact, price_labels, keep_empty=False),
    }


def write_aggregates(tables: dict[str, DataFrame], path: str, csv: bool = False) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
        if csv:
            written = table.sparkSession.read.parquet(f"{path}/{name}")
            written.write.mode("overwrite").option("header", True).csv(f"{path}/{name}_csv")
