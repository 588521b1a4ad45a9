"""A corpus made ready for training: quality, near duplicates, benchmark passages, mixture, shards.

Each stage takes the documents that the one before kept and returns them with their own columns; the last adds
``size``, ``text_crc32``, ``shard`` and ``slot``. ``run`` writes every stage below the shared folder and reads it again.

All but the last return the input's own columns unchanged, whatever their names; the last puts its own in place of those
named alike. Null texts count as empty, null ids as ids like others. No documents give no documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqspark.llm import decontaminate, mixing, quality, sharding, simhash
from dqspark.llm.common import Rows, given
from dqspark.session import stored

#: SQL has no boosting, fingerprints, latent space or hypergeometric draws; the tests hold the stages against brute force.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject. Empty texts are judged too; repeated rows are judged alike."""
    if docs.isEmpty():
        return docs
    model, rows = quality.train(docs, given(spark, sf_dir, "labels")), Rows(docs)
    return rows.back(quality.scored(rows.frame, model, text=rows.of["text"]).filter("predicted = 1"))


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; of rows that repeat it, one."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; empty ones hold none. Repeated rows stay or go together."""
    return decontaminate.clean(docs, given(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, so that sources have their weights; a document taken twice is there twice.

    Null is a source like others; repeated rows are documents of their own.
    """
    rows = Rows(docs)
    return rows.back(mixing.mix(rows.frame, id=rows.of["doc_id"], text=rows.of["text"], source=rows.of["source"]))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in shards of near equal bytes; copies of a text share a shard unless they are much of one."""
    return sharding.shard(docs, shards=24)


STAGES = [
    ("quality", good),
    ("near duplicates", unlike),
    ("decontamination", unleaked),
    ("mixture", mixed),
    ("shards", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
