"""A training corpus from raw documents: toxic ones go, near-duplicates go, personal data is masked, sources are mixed, text becomes ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. A stage works on all rows that the one before it kept.

Defined cases: a null text is never toxic, its own group of near-duplicates with other texts without words, has
size 0 in the mixture and becomes the end id alone; null sources are one source; rows with a null id stay as
their group's smallest id only where no row of the group has one; repeated rows count as copies, of which one stays
before mixing; very long texts are read whole by each stage; without labels nothing is toxic; an empty table
gives an empty result; columns other than those of documents are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import mixing, pii, sentencepiece_bpe, simhash, toxicity
from stopwise.llm.common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go; it learns from the labels of the given documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the group's smallest id. SimHash and its Gray-order index link first, min-hashes what is left."""
    return simhash.keep_one(docs).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind in angle brackets; n_chars follows the new text."""
    found = pii.find(docs, pii.fit(docs))
    return pii.redact(found).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as often as the mix takes them (0 to 3 times)."""
    return mixing.repeat(mixing.mix(docs)).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, end id last, and the text that decoding gives back."""
    out = sentencepiece_bpe.encode_decode(docs, sentencepiece_bpe.default_model(), decoded_col="text", keep=["doc_id", "lang", "source"])
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"), "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Trained models and components are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
