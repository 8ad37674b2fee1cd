"""The raw extract: one headered CSV under a fixed header contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.functions.columns import null_if_nan, trimmed
from venuelens.operators.cleaning import normalise_names
from venuelens.schemas import RAW_HEADER

# Text that stands for a missing value in the extract.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Columns that give every row its place in the source.
SOURCE_ORDER = ("_file", "_block", "_row")


class HeaderError(ValueError):
    """The file does not have the columns the engine depends on."""


def read_raw(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1", multi_line: bool = False
) -> DataFrame:
    """Rows of the extract under engine names and types, plus their source order.

    The columns are found by header name, in any order; unknown ones are ignored.
    Large files are split over tasks. That needs records of one line each: a line with
    fewer or more fields than the header, such as one cut by a line break inside quotes,
    fails the read. ``multi_line`` allows such breaks, at the price of one task per file;
    there, missing fields at the end of a record are blank.
    """
    # Columns are matched by name, so the text is read under the file's own header.
    options = {
        "header": True,
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "enforceSchema": False,
        # Fields are counted in whole records, so all are parsed where the count matters.
        "columnPruning": multi_line,
        "mode": "PERMISSIVE" if multi_line else "FAILFAST",
    }
    reader = spark.read.options(**options)
    header = reader.csv(path).columns
    names = {name.strip() for name in header}
    missing = [name for name in RAW_HEADER if name not in names]
    if missing:
        raise HeaderError(f"{path}: missing columns {missing}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = reader.schema(text).csv(path).withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    rows = normalise_names(rows)
    columns = [_typed(source, name, kind) for source, (name, kind) in RAW_HEADER.items()]
    return rows.select(*columns, *SOURCE_ORDER)


def write_raw(rows: DataFrame, path: str, encoding: str = "ISO-8859-1") -> None:
    """Rows under engine names as an extract that ``read_raw`` reads back, one headered file for each
    partition, in the order of the partitions.

    Missing values are blank, quotes are doubled and padding stays. Characters outside the encoding
    become question marks; a text equal to a null token comes back as null, and one with a line
    break needs ``multi_line`` to be read.
    """
    header = [F.col(name).cast("string").alias(source) for source, (name, _) in RAW_HEADER.items()]
    options = {
        "header": True,
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    rows.select(*header).write.options(**options).csv(path)


def _typed(source: str, name: str, kind: T.DataType):
    text = F.col(f"`{source}`")
    known = F.when(~text.isin(*NULL_TOKENS), text)
    if isinstance(kind, T.StringType):
        return known.alias(name)
    number = known.try_cast("double") if isinstance(kind, T.DoubleType) else None
    if number is not None:
        return null_if_nan(number).alias(name)
    # Whole numbers may be written as 3 or 3.0.
    word = trimmed(known)
    return F.coalesce(word.try_cast(kind), word.try_cast("double").try_cast(kind)).alias(name)
