"""From raw documents to a training mix: every stage is one operator of ``siteatlas.llm``, applied to what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's documents. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteatlas.llm import bitmap, jaccard, language, mixing, suffixes, winnowing
from siteatlas.session import new_work_dir, persist_reliably

#: A text must reach this share of known n-grams; a short one only what a text that knows ``CLEAN_SHARE`` of them falls below by chance in
#: one of about 700 cases, ``SIGMAS`` standard deviations: nothing up to 9 n-grams, the whole of it from 25.
LEAST_SCORE = 0.2
CLEAN_SHARE = 0.5
SIGMAS = 3


def _without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``gone``. Only rows that a bitmap of fixed size lets through are shuffled for the join."""
    gone = persist_reliably(gone.select(key).distinct())
    hashed = F.xxhash64(key)
    maybe = bitmap.test(docs.sparkSession, bitmap.build(gone, hashed), hashed)
    return docs.filter(~maybe).unionByName(docs.filter(maybe).join(gone, key, "left_anti").select(*docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: without a letter, or of more unknown n-grams than their number explains, they go."""
    found = docs.withColumn("__found", language.column(spark, language.learn(docs), F.col("text")))
    known = F.col("__found.lang_pred") != "und"
    chance = SIGMAS * F.sqrt(CLEAN_SHARE * (1 - CLEAN_SHARE) / F.greatest(F.col("__found.n_grams"), F.lit(1)))
    least = F.least(F.lit(LEAST_SCORE), CLEAN_SHARE - chance)
    return found.filter(known & (F.col("__found.score") >= least)).select(*docs.columns)


def _once(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with one of the rows of equal key and text, the first by its columns as JSON."""
    copy = F.xxhash64(key, "text")
    copies = persist_reliably(docs.groupBy(copy.alias("copy")).agg(F.count("*").alias("n")).filter("n > 1").select("copy"))
    if copies.isEmpty():
        return docs
    maybe = bitmap.test(docs.sparkSession, bitmap.build(copies, F.col("copy")), copy)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = docs.filter(maybe).groupBy(copy.alias("copy")).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return docs.filter(~maybe).unionByName(first.select("row.*"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of linked documents, and one of its repeated rows.

    Rows of one id and different texts stay or go together. A row without an id gets one of 2^62 and more from its text, for this stage only.
    """
    surrogate = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), surrogate))
    found = jaccard.components(keyed, id_col="__key", k=5, percent=80)
    return _without(_once(keyed, "__key"), found.filter("__key <> component_id"), "__key").select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that stand earlier in the corpus; ``n_chars`` follows."""
    kept = suffixes.remove(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words with a benchmark item."""
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = winnowing.find(keyed, items, id_col="__key").filter("size(spans) > 0")
    return _without(keyed, hit, "__key").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``mix_copies`` saying how often."""
    return mixing.mix(docs, prefix="mix_").filter("mix_copies > 0")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: A learned language model decides the first stage, which SQL cannot express.
ORACLE_SQL = None
