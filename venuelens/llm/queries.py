"""Registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm import (
    bpe, chat, codes, decontaminate, langid, mixture, sharding, simhash, tokens, toxicity, urls, vectors, whitening,
)
from venuelens.llm.tables import held_out, read

Query = Callable[[SparkSession, str], DataFrame]

# The rules, folds and limits of the queries.
RULES = (
    urls.Rule("net", "/", urls.BLOCK),
    urls.Rule("example.net", "/en/", urls.ALLOW),
    urls.Rule("example.com", "/de/", urls.BLOCK),
    urls.Rule("org", "/fr/", urls.ALLOW),
)
TOXIC_FOLD, LANG_FOLD = (5, 0), (4, 2)
TOKEN_LIMIT = 2048
TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
LEVELS = ("domain", "lang", "source")
WEIGHTS = {
    "domain": {"web": 0.6, "books": 0.4},
    "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
}
MIX = mixture.Mix(LEVELS, WEIGHTS, share=1.0, epochs=4)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    labelled = read(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), *TOXIC_FOLD))
    return toxicity.train(docs, labelled)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    score = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), *TOXIC_FOLD).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(read(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = held_out(F.col("doc_id"), *LANG_FOLD)
    model = langid.train(docs.where(~fold))
    rows = docs.select("doc_id", fold.alias("held_out"), langid.predicted(docs, model).alias("p"))
    return rows.select("doc_id", "held_out", "p.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.rotated(read(spark, sf_dir, "conversations")))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    count = tokens.counted(docs, tokens.prove(tokenizer_path()))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", size.alias("n_bytes"), count.alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("domain", mixture.domain(F.col("source")))
    return mixture.mixed(docs, MIX)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    source = bpe.load(tokenizer_path(BYTE_TOKENIZER))
    rows = docs.select("doc_id", bpe.encoded(docs, source).alias("ids"))
    rows = rows.select("doc_id", "ids", bpe.decoded(docs, source, F.col("ids")).alias("decoded"))
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(*codes.compressed(read(spark, sf_dir, "embeddings")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_vectors": op5_vectors,
    "op6_chat": op6_chat,
    "op7_tokens": op7_tokens,
    "op8_urls": op8_urls,
    "op9_decontaminate": op9_decontaminate,
    "op10_mixture": op10_mixture,
    "op11_bpe": op11_bpe,
    "op12_codes": op12_codes,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}

MIXTURE_SQL = """
WITH counted AS (
  SELECT doc_id,
    CASE WHEN coalesce(regexp_extract(source, '([0-9]{1,9})$', 1), '') = '' THEN 'other'
         WHEN CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT) < 10 THEN 'web' ELSE 'books' END AS domain,
    coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x09-\\x0D\\x20]+')), 0) AS BIGINT) AS tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM counted GROUP BY ALL
), d AS (
  SELECT domain, sum(tokens) * 4.0::DOUBLE AS holds,
         CASE domain WHEN 'web' THEN 0.6::DOUBLE WHEN 'books' THEN 0.4 ELSE 1 END AS w,
         (SELECT sum(tokens)::DOUBLE FROM leaves) AS budget
  FROM leaves GROUP BY domain
), d1 AS (
  SELECT *, (budget - coalesce(sum(holds) OVER (ORDER BY holds / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY holds / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS multiple FROM d
), d2 AS (
  SELECT domain, greatest(least(holds, w * max(multiple) OVER ()), 0) AS budget FROM d1
), l AS (
  SELECT domain, lang, sum(tokens) * 4.0::DOUBLE AS holds,
         CASE lang WHEN 'en' THEN 0.4::DOUBLE WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.2 WHEN 'es' THEN 0.2 ELSE 1 END AS w
  FROM leaves GROUP BY domain, lang
), l1 AS (
  SELECT *, (budget - coalesce(sum(holds) OVER (PARTITION BY domain ORDER BY holds / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (PARTITION BY domain ORDER BY holds / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS multiple
  FROM l JOIN d2 USING (domain)
), l2 AS (
  SELECT domain, lang, greatest(least(holds, w * max(multiple) OVER (PARTITION BY domain)), 0) AS budget FROM l1
), s AS (
  SELECT domain, lang, source, tokens, tokens * 4.0::DOUBLE AS holds, 1.0::DOUBLE AS w FROM leaves
), s1 AS (
  SELECT *, (budget - coalesce(sum(holds) OVER (PARTITION BY domain, lang ORDER BY holds / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (PARTITION BY domain, lang ORDER BY holds / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS multiple
  FROM s JOIN l2 USING (domain, lang)
), quotas AS (
  SELECT domain, lang, source, tokens AS leaf_tokens, CAST(floor(round(
         greatest(least(holds, w * max(multiple) OVER (PARTITION BY domain, lang)), 0), 6)) AS BIGINT) AS quota
  FROM s1
), shares AS (
  SELECT *, CASE WHEN leaf_tokens = 0 THEN 0 ELSE quota // leaf_tokens END AS whole FROM quotas
), placed AS (
  SELECT c.*, whole, quota - whole * leaf_tokens AS rest,
         md5('20:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM counted c JOIN shares USING (domain, lang, source)
), summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id NULLS FIRST
         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM placed
), taken AS (
  SELECT *, least(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END, 4) AS n FROM summed
)
SELECT doc_id, domain, lang, source, tokens, CAST(unnest(range(n)) AS BIGINT) AS epoch FROM taken WHERE n > 0
"""

ORACLES: dict[str, str] = {"op6_chat": chat.ORACLE, "op10_mixture": MIXTURE_SQL, "op12_codes": codes.oracle()}
