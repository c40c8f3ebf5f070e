"""From raw documents to packed training sequences: every stage works on all rows its predecessor kept.

The columns of a row travel in one struct while an operator works on it, so an operator's own columns never meet a
column of the table. Stages keep rows with null, empty or very long texts unless their rule rejects them; an empty
table stays an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.llm import toxicity
from ridepulse.llm.common import store
from ridepulse.llm.decontamination import contamination
from ridepulse.llm.packing import pack
from ridepulse.llm.queries import TOKENIZER, label_remainder, table
from ridepulse.llm.secrets import redact, scan, with_findings
from ridepulse.llm.simhash import representatives
from ridepulse.session import configure


def _boxed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("_doc"), F.col("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window stays below the threshold. The labels that teach this are those of the table."""
    known = docs.select("doc_id", "text")
    network = toxicity.fit(known, "doc_id", "text", table(spark, sf_dir, "labels"), "doc_id", "toxic", label_remainder("doc_id") != 1)
    rows = toxicity.score(_boxed(docs), ["_doc"], "text", network)
    return rows.filter(F.col("score") < toxicity.THRESHOLD).select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that links of at most 2 bits connect: that with the smallest id."""
    return representatives(docs, "doc_id", "text", words=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window of 13 words."""
    rows = contamination(_boxed(docs), "text", table(spark, sf_dir, "benchmark"), "item_id", "text", window=13)
    return rows.filter("not contaminated").select("_doc.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each stretch of secrets replaced by a mark; n_chars follows the text."""
    rows = with_findings(_boxed(docs), "text", scan(docs.select("text"), "text").findings)
    rows = rows.withColumn("text", redact("text", "spans"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        own = F.col("_doc")[name]
        if name == "n_chars":
            own = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return rows.select(*[column(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, each with the sources in their shares."""
    pieces = pack(docs, "text", "source", ["doc_id"], public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: The first stage is a trained network and the last one a tokenizer: neither can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
