"""Corpus pipeline: documents in, packed sequences out.

Stages, in order: quality classifier, n-gram Jaccard join, benchmark
decontamination, personal data, best-fit packing.  Each takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's docs; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm import decontam, packing, parity_join, pii_crf, quality
from zonelens.llm.common import by_ids, table, written
from zonelens.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MAX_COVERAGE = 0.5           # documents with a larger share of benchmark words go


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of `documents` with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws; the rejected ones go.  A NULL id stays."""
    drawn = quality.resample(docs, table(spark, sf_dir, "labels"))
    return by_ids(docs.select(*COLUMNS), drawn.filter("not keep").select("doc_id"), "left_anti")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every similarity class.  A NULL id stays; so does every row
    of a kept id but its exact repetitions."""
    classes = written(spark, parity_join.similarity_classes(docs), "classes")
    kept = by_ids(docs.select(*COLUMNS), classes.filter("component_id <> doc_id").select("doc_id"), "left_anti")
    again = classes.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    again = written(spark, again, "repeated-ids")
    return by_ids(kept, again, "left_anti").unionByName(by_ids(kept, again, "left_semi").dropDuplicates(COLUMNS))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return _documents(decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), max_coverage=MAX_COVERAGE))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets."""
    return _documents(pii_crf.scan(docs.select(*COLUMNS), redact=True))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", remove_benchmark),
    ("personal_data", mask_personal),
    ("packing", pack_sequences),
]

ORACLE_SQL = None            # sampling, the random field and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
