"""A training corpus from `documents`: five stages, each written as Parquet and read again.

1. language: documents without a letter, or in no language the network knows, go.
2. near_duplicates: one document of each group stays, that of the smallest id; texts whose SimHash
   fingerprints of 3-word shingles differ in at most three bits are in one group.
3. contamination: documents that hold a window of a benchmark item go.
4. secrets: findings that the forest keeps are replaced in the text; all documents stay.
5. mixing: every document gets a rate and copies, so that domains reach their target shares of
   tokens; documents that are to be drawn zero times go.

All stages but the last return the columns of `documents`. A null in any column is kept as it is; an
empty table passes through. Extra columns stay, whatever their names, but for domain, rate and copies,
which the last stage replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import contamination, language, mixing, secrets, simhash_groups
from tidegate.llm.scratch import shipped, written

#: A text counts as no known language where its pooled probability is below so many times that of chance.
LEAST_ODDS = 1.2


def _names(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _free(docs: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column has."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = f"_{name}"
    return name


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    net = language.fit(docs.where(~language.held_out("doc_id", 4, 2)))
    if net is None:  # no labelled text to learn from: only what has no letter can be told
        return docs.where(F.col("text").rlike("\\p{L}"))
    label, score = _free(docs, "lang_pred"), _free(docs, "score")
    found = language.identify(docs, net, names_as=(label, score))
    least = min(LEAST_ODDS / len(net.languages), 0.5)
    return found.where((F.col(label) != "und") & (F.col(score) >= least)).select(*_names(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return simhash_groups.keep_one_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.drop_contaminated(docs, shipped(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    clean = secrets.redact(docs, secrets.scan_secrets(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = mixing.domain_labels(shipped(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    out = mixing.mix(docs, labels, mixing.TARGETS, keep_text=True)
    new = ("domain", "rate", "copies")
    return out.where("copies > 0").select(*_names(docs.drop(*new)), *new)


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("contamination", decontaminated),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

#: Trained models and groups of near duplicates have no twin in SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
