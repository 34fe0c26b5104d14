"""Corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents`` (the last one the index of the token
files).  ``run`` writes every stage's result as Parquet to the shared folder and rereads
it for the next.

1. language      documents without a recognisable language go, the others' missing languages are filled
2. near copies   of each group linked by 5-word shingles (similarity 0.75) one stays
3. benchmark     documents that hold a benchmark item go
4. mixing        rows are taken as often as the sources' target weights ask
5. tokens        token ids in seekable files; one row per document read back
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.llm import decontaminate, jaccard_join, language, mixing, token_files
from bankmart.llm.common import documents, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives texts without ``lang`` the predicted one, and rejects only what has no
    language: null, empty and letterless texts; a text with letters stays whatever its
    score, also where no row taught a language (its ``lang`` then stays null).
    The model learns from the rows of the training folds."""
    model = language.fit(docs, language.in_training(F.col("doc_id")))
    judged = language.identify(docs, model)
    found = F.when(F.col("lang_pred") != "und", F.col("lang_pred"))
    return _columns(judged.filter(found.isNotNull() | F.col("text").rlike(r"\p{L}"))
                    .withColumn("lang", F.coalesce("lang", found)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(jaccard_join.one_of_each(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _columns(decontaminate.without_leaks(docs, items))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(mixing.mixed(docs))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.read_tokens(token_files.write_tokens(docs))


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_each_group),
    ("benchmark", without_benchmark),
    ("mixing", mixed_sources),
    ("tokens", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32")


#: trained and tokenised stages have no SQL form; tests compare with brute force
ORACLE_SQL = None
