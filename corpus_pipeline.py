"""A training-corpus pipeline over the documents table, made of the corpus operators.

Each stage takes (spark, docs, sf_dir), docs being all that the stage before it kept, and all but the last return the columns of docs.
SQL can't express compression, a trained model or a tokenizer, so there is no ORACLE_SQL; tests hold each stage against a brute-force version.

In all stages nulls in any column, repeated rows, an empty table and columns of any name are allowed, and whole texts count, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lookout.llm.common import documents, materialise, prepare, temporary
from lookout.llm.jaccard import keep_one
from lookout.llm.langid import keep_identified
from lookout.llm.mil import keep_quality
from lookout.llm.mixing import mixed_documents
from lookout.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told without rejection.

    A null or empty text, one without a letter and one with a narrow margin go; repeated rows stay or go together.  Where no row has a
    language to learn from, all go.
    """
    return keep_identified(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from `labels`, doesn't reject.

    Repeated rows stay or go together; a null id only means that no label is the row's.  Without labels of both kinds all have one score, and stay or go together.
    """
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at 80 % of shingles of five words: the one with the least id, null last.

    Texts without words, null ones among them, are linked with nothing and all stay; of repeated rows one stays.
    """
    return keep_one(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as many of their passages, as the sources' target weights take.

    A null source is a source, the last; texts without words leave no row; repeated rows each count.
    """
    return mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    A null or empty text is its end id alone; null ids and repeated rows are packed like any other.
    """
    return pack(docs)


STAGES = [("language", language), ("quality", quality), ("near duplicates", near_duplicates), ("mixture", mixture), ("sequences", sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another.  A stage's table goes when the next one is written, as do the tables that a stage writes for itself; what the last one
    reads stays, as its result is lazy, until lookout.llm.common.clear()."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    with temporary(spark) as keep:
        for name, stage in STAGES[:-1]:
            with temporary(spark) as keep_stage:
                docs = keep_stage(materialise(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
