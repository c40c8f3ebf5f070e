"""Secret scans with an incremental blob ledger.

Every version of every file is addressed by the SHA-256 of its text. A ledger holds the (blob, rule version) pairs
that were scanned, and only pairs that are not in it are scanned, each once however many paths hold the blob. The
findings belong to blobs and are joined back to all paths.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, store


@dataclass(frozen=True)
class Rule:
    """A pattern, the group that must have at least ``least`` characters, and that number."""

    kind: str
    pattern: str
    group: int
    least: int


#: Kinds in the order that breaks ties, and their patterns. The last two carry their least length, as
#: their matches are whole runs.
RULES = (
    Rule(
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
        r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
FINDING = "blob string, rule_version string, kind string, rank int, start long, end long, hit string"
LEDGER = "blob string, rule_version string"


def version_of(rules: tuple[Rule, ...]) -> str:
    """The version of a rule set: it changes with any rule."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def blob_of(text: Column) -> Column:
    """Content address of a version; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


@dataclass
class Scan:
    """Findings of all blobs seen so far, the ledger after this run, and the blob of every row."""

    findings: DataFrame
    ledger: DataFrame
    new_findings: DataFrame
    new_entries: DataFrame


def scan(
    df: DataFrame,
    text: str,
    ledger: DataFrame | None = None,
    findings: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> Scan:
    """Scan the blobs of ``text`` that the ledger does not have for these rules; ``findings`` are the earlier ones.

    Positions are code points, end exclusive. Matches of a kind are leftmost and do not overlap; those whose group is
    too short are dropped after matching. Null texts are the empty blob. Equal texts are one blob, so copies cost one
    scan. An empty table scans nothing.
    """
    version = version_of(rules)
    blobs = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"), blob_of(F.col(text)).alias("blob"))
    # copies meet in their own tasks first, so that none of a hot text's many rows is compared with the ledger
    unseen = blobs.dropDuplicates(["blob"])
    if ledger is not None:
        done = ledger.filter(F.col("rule_version") == version).select("blob").distinct()
        unseen = unseen.join(done, "blob", "left_anti")
    # one pass over the text of the unseen blobs: the matches of every kind and what lies between them
    found = F.array(
        *[
            F.struct(
                F.lit(rule.kind).alias("kind"),
                F.lit(rank).alias("rank"),
                F.lit(rule.least).alias("least"),
                F.when(F.col("text").rlike(rule.pattern), _matches(rule)).alias("matches"),
            )
            for rank, rule in enumerate(rules)
        ]
    )
    scanned = store(unseen.select("blob", F.filter(found, lambda f: f["matches"].isNotNull()).alias("found")), "scanned-blobs")
    kinds = scanned.select("blob", F.explode("found").alias("f")).select("blob", "f.kind", "f.rank", "f.least", "f.matches")
    hits = kinds.select("blob", "kind", "rank", "least", F.posexplode("matches").alias("i", "m"))
    upto = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.length("m.hit")).over(upto)
    placed = hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("m.hit"))
    fresh_findings = placed.filter(F.length("m.value") >= F.col("least")).select(
        "blob", F.lit(version).alias("rule_version"), "kind", "rank", "start", "end", F.col("m.hit").alias("hit")
    )
    fresh_findings = store(fresh_findings, "findings")
    new_entries = entries = scanned.select("blob", F.lit(version).alias("rule_version"))
    new_findings = fresh_findings
    if ledger is not None:
        entries = ledger.select("blob", "rule_version").unionByName(entries)
    if findings is not None:
        fresh_findings = findings.unionByName(fresh_findings)
    return Scan(fresh_findings, entries, new_findings, new_entries)


@dataclass(frozen=True)
class Ledger:
    """A stored ledger and its findings; every delivery adds what it is the first to hold."""

    spark: SparkSession
    folder: str

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        self.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    @property
    def entries(self) -> DataFrame:
        return self._table("ledger", LEDGER)

    @property
    def findings(self) -> DataFrame:
        return self._table("findings", FINDING)

    def add(self, delivery: DataFrame, text: str, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the blobs of a delivery that no delivery before it held under these rules.

        Findings are stored before their ledger entries: a run that breaks off between the two scans these blobs
        again, and findings that are stored twice count once.
        """
        found = scan(delivery, text, self.entries, rules=rules)
        found.new_findings.write.mode("append").parquet(f"{self.folder}/findings")
        found.new_entries.write.mode("append").parquet(f"{self.folder}/ledger")


def _matches(rule: Rule) -> Column:
    """Each match with its tested group and the length of the text between it and the match before."""
    hits = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda g: F.length(g))
    zipped = F.arrays_zip(hits.alias("hit"), values.alias("value"), F.slice(gaps, 1, F.size(hits)).alias("gap"))
    return F.transform(zipped, lambda z: F.struct(z["hit"].alias("hit"), z["value"].alias("value"), z["gap"].alias("gap")))


def spans_of_blobs(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per blob with findings of the rules: its spans by start, then kind as listed."""
    current = findings.filter(F.col("rule_version") == version_of(rules))
    span = F.struct("start", "rank", "end", "kind")
    return store(current.groupBy("blob").agg(F.array_sort(F.collect_set(span)).alias("spans")), "blob-spans")


def with_findings(df: DataFrame, text: str, findings: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """All rows with the spans of their blob (an empty array where there are none) in column ``name``.

    Rows of one blob may be any share of all; the join then splits them, as the other side is a stored table.
    """
    blob = fresh([*df.columns, name], "_blob")
    spans = spans_of_blobs(findings, rules).select(F.col("blob").alias(blob), F.col("spans").alias(name))
    rows = df.drop(name).withColumn(blob, blob_of(F.col(text))).join(spans, blob, "left").drop(blob)
    empty = F.array().cast(spans.schema[name].dataType)
    return rows.withColumn(name, F.coalesce(name, empty))


def redact(text: str, spans: str, mark: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping spans replaced by the mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done: Column, span: Column) -> Column:
        apart = span["start"] >= done["at"]
        between = F.col(text).substr((done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        out = F.when(apart, F.concat(done["out"], between, F.lit(mark))).otherwise(done["out"])
        return F.struct(out.alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.col(text).substr((done["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(F.col(text))
