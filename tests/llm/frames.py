"""Small awkward tables for the corpus operators."""

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor " * 40_000
# (doc_id, text, lang, source, n_chars)
AWKWARD = [
    (1, "one two three four five", "en", "src1", 23),
    (1, "one two three four five", "en", "src1", 23),  # repeated row
    (2, "One TWO three four five", "en", None, 23),
    (3, None, None, "src2", None),
    (4, "", "en", "src2", 0),
    (5, " \t\n", "de", "src12", 3),
    (6, LONG, "en", "src12", len(LONG)),
    (7, "ein zwei", "de", "odd", 8),
    (None, "no id here at all", "en", "src1", 17),
    (None, None, None, None, None),
    (8, "123 456 !!", None, "src1", 10),
    (9, "naïve café 東京 😀", "fr", "src3", 16),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def clashing(docs):
    """The same rows with further columns, named as columns that operators make."""
    names = ["fp", "key", "shard", "score", "p", "n", "component_id", "place", "bucket", "domain", "x", "m", "id", "size"]
    return docs.withColumns({name: F.lit(f"own {name}") for name in names})


def values(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
