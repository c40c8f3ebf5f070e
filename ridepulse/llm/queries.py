"""The registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch
from . import oracles, toxicity, whitening
from .alignment import align
from .decontamination import contamination
from .jaccard import jaccard_components
from .licenses import scan as license_scan
from .lm import score
from .packing import pack
from .quality import quality
from .secrets import RULES, Ledger, with_findings
from .sharding import assign_shards, number_in_shards
from .simhash import near_duplicates
from .tokenstore import block_starts, read_tokens, write_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def label_remainder(key: str) -> Column:
    """Labels of rows with a remainder of 1 are held out."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % 3


SHARDS = 40


@query("op1_rendezvous_sharding", oracles.SHARDING)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 40 shards of equal weight by the hash of their id."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law")
    )
    return number_in_shards(assign_shards(docs, "doc_id", [1.0] * SHARDS, grown="grown_shard"), ["doc_id"])


TOKENIZER = "byte_bpe_50k.json"


@query("op3_mixture_packing")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, each with the sources in their shares."""
    pieces = pack(table(spark, sf, "documents"), "text", "source", ["doc_id"], public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op9_token_files")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as compressed token files, and what reading them back gives."""
    folder = scratch(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), "doc_id", "text", folder, public_tokenizers.path(TOKENIZER))
    read = read_tokens(spark, folder).select("doc_id", "block", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    starts = block_starts(spark, folder)
    return read.join(starts, "block").select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


@query("op4_simhash")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of every document, links at 2 bits or fewer."""
    found = near_duplicates(table(spark, sf, "documents"), "doc_id", "text", words=3, radius=2)
    digits = F.lower(F.lpad(F.hex("_print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("_component").alias("component_id"))


@query("op7_secret_scan", oracles.SECRETS)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document, which come in two deliveries; texts that the first one held are not scanned again."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ledger = Ledger(spark, scratch(spark, "secret-ledger"))
    early = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 2 == 0
    for delivery in (docs.filter(early), docs.filter(~early)):
        ledger.add(delivery, "text")
    rows = with_findings(docs, "text", ledger.findings).drop("text")
    marks = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    joined = F.array_join(marks, ",")
    return rows.select("doc_id", *[count(rule.kind) for rule in RULES], F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))


@query("op2_winnowing", oracles.CONTAMINATION)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = contamination(docs, "text", table(spark, sf, "benchmark"), "item_id", "text", window=13)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op8_robust_quality")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and robust distances of every document within its language and source."""
    return quality(table(spark, sf, "documents"), "text", "lang", "source", ["doc_id"])


@query("op6_backoff_automaton")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Log-probability of every document under the model of those that are not held out."""
    remainder = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 10
    return score(table(spark, sf, "documents"), "doc_id", "text", remainder == 0)


@query("op5_toxicity")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """The toxicity of every document; labels with a remainder of 1 are never learnt from."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    network = toxicity.fit(docs, "doc_id", "text", table(spark, sf, "labels"), "doc_id", "toxic", label_remainder("doc_id") != 1)
    rows = toxicity.score(docs, ["doc_id"], "text", network)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return rows.select("doc_id", (label_remainder("doc_id") == 1).alias("held_out"), "score", predicted)


@query("op10_license_scan")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """The license of every document: its own notice, or that of the nearest directory with a licence file.

    Documents are files in a tree that their source and the digits of their id span: document 1234 of src1 is
    src1/1/2/3/4. A text of which a notice or a licence has at least half the words, however long or short, is its
    directory's licence file.
    """
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    digits = F.concat_ws("/", F.filter(F.split(F.col("doc_id").cast("string"), ""), lambda c: c != ""))
    files = docs.withColumn("path", F.concat(F.coalesce("source", F.lit("")), F.lit("/"), digits))
    found = license_scan(files, "path", "text", F.lit(False), covering=0.5)
    return found.select("doc_id", "path", "own_license", "similarity", "license", "source_directory")


PIECES = "piece_bpe_32k.model"


@query("op11_token_alignment")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, with the corpus counts of the linked id pairs."""
    return align(table(spark, sf, "documents"), "doc_id", "text", public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


@query("op12_spectrum_whitening")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """The leading 32 whitened components of every embedding."""
    rows = table(spark, sf, "embeddings")
    model = whitening.fit(rows, "embedding", components=32)
    white = whitening.whiten(rows, "vec_id", "embedding", model)
    error = whitening.identity_error(rows, "embedding", model)
    return white.withColumn("n", F.lit(model.n).cast("long")).withColumn("identity_error", F.lit(error).cast("double"))


@query("op13_prefix_tree_join")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard_components(table(spark, sf, "documents"), "doc_id", "text", words=3, threshold=90)
