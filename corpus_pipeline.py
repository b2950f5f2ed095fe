"""A corpus pipeline: five operators of edgeworks.llm, each stage on all that the one before it kept.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.llm import bpe, decontaminate, secrets, simhash, toxicity
from edgeworks.llm.tables import ensure_checkpoint_dir, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    return toxicity.score(docs.select(*COLUMNS), toxicity.fit_toxic(spark, docs, sf_dir)).where("score < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest doc_id.

    A row without doc_id stays, since no row stands for it. Repeated rows of a doc_id count as one document.
    """
    groups = simhash.near_components(simhash.fingerprints(docs.select("doc_id", "text"))).where("doc_id = component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(groups, "doc_id", "left_semi").unionByName(docs.select(*COLUMNS).where("doc_id IS NULL")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule leaves alone."""
    found = decontaminate.find_contamination(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret span replaced; n_chars follows the text."""
    found = secrets.find_secrets(docs.select(*COLUMNS), secrets.fit(docs))
    clean = found.withColumn("text", secrets.redact())
    return clean.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of what they decode to."""
    return bpe.token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; between two stages the rows lie as Parquet in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs


#: No stage but the last can be said in SQL: a trained model, sketches of shingles and inferred automata decide.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
