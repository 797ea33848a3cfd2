"""A training corpus in five stages: toxic documents go, then recurring lines, then near-duplicates; what is left is mixed to the
sources' weights and packed into sequences. Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutweave.llm import linededup, mixing, packing, simhash, toxicity
from cutweave.llm.common import table, written
from cutweave.llm.learning import known_fold

#: SQL expresses neither the trained scores nor the fingerprints nor the packing.
ORACLE_SQL = None


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that are scored toxic. The labels of the learnable folds train the scores; rows without an id
    are kept or rejected by their own text like all others."""
    labels = table(spark, sf_dir, "labels").filter(~known_fold(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD)).select("doc_id", F.col("toxic").alias("y"))
    model = toxicity.train(docs, labels)
    # the whole row goes along as the key, so rows that share an id are judged apart and nothing is joined
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return toxicity.score(rows, model, id_col="row", details=False).filter("predicted = 0").select("doc_id.*")


def recurring_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template recurs in a document before them; n_chars counts what is left."""
    kept = linededup.drop_recurring(docs, counts=False)
    return kept.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: SimHash proposes, a Jaccard of 0.8 or more on shingles of five words links."""
    return simhash.one_of_each(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, by sequence and offset, with their ids."""
    return packing.pack(docs)


STAGES = [("toxicity", toxic_out), ("line dedup", recurring_lines_out), ("simhash near-dedup", near_duplicates_out), ("source mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
