"""Documents to packed training sequences in five stages, each a written table.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the documents of the next. All but
the last keep the columns of documents. ``run`` applies them to the documents of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.exact import drop_copies
from shelfwise.llm.minhash import drop_near_copies
from shelfwise.llm.mixing import mixed_documents
from shelfwise.llm.packing import pack
from shelfwise.llm.quality import good_documents, graded, train
from shelfwise.session import stage, tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on the labels of these documents."""
    labels = tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return good_documents(docs, train(docs, graded(labels)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight; documents repeat, or come in part, as their blocks are taken."""
    return mixed_documents(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing", mixing),
    ("packing", packing),
]

# the classifier, the sketches and the tokens are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
