"""Quality rules with robust multivariate outliers.

Base rules drop very short and very repetitive texts. The statistics of the others are transformed to a vector, and
the vectors of each language and source get a minimum-covariance-determinant estimate: from each of two starts, the share
``SUBSET`` of rows with the smallest Mahalanobis distance gives the next mean and covariance, until no determinant falls
any more, and the smaller determinant wins. Rows far from their group's centre are rejected.

A step is one aggregate of counts, sums and cross products by group and distance class. No task holds a group, and a
group's sums are combined before the shuffle, so one source may have most of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, let, store, word_grams

#: The characters of SPACE.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: The vector, and a small standard deviation added to each part so that a constant part stays regular. One of the last
#: two is zero for most texts: the floor is then the whole spread, and a text with 8 % repeated words is far out.
PARTS = ["x_words", "x_length", "x_symbols", "x_lines", "x_repeat"]
FLOORS = [0.02, 0.01, 0.01, 0.02, 0.02]
P = len(PARTS)
SUBSET = 0.75
#: A determinant that falls by less than this share stands still. More steps than any group takes: a limit that raises.
FALL = 1e-3
MOST_STEPS = 50
#: A row is rejected beyond this quantile of the squared distance.
QUANTILE = 0.99
#: A smaller group is pooled: sources within their language, then languages.
SMALLEST = 50


def _gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _gamma_share(freedom / 2, mid / 2) < share else (low, mid)
    return high


#: Makes the covariance of the closest rows an estimate for normal data.
CONSISTENCY = SUBSET / _gamma_share(P / 2 + 1, chi_square_quantile(SUBSET, P) / 2)
CUTOFF = chi_square_quantile(QUANTILE, P)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice, the first occurrence included."""

    def count(grams: Column) -> Column:
        def covered(order: Column) -> Column:
            def twice(pair: Column, i: Column) -> Column:
                # get() of a position outside is null
                before, after = F.get(order, i - 1)["h"], F.get(order, i + 1)["h"]
                return F.coalesce(before == pair["h"], F.lit(False)) | F.coalesce(after == pair["h"], F.lit(False))

            starts = F.transform(F.filter(order, twice), lambda p: p["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

        order = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(let(order, covered))

    return let(words, lambda w: let(word_grams(w, 3), count))


def statistics(text: Column) -> list[Column]:
    """The five base statistics of a whole text; null has none of anything."""
    known = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(known, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    return [
        F.size(F.array_remove(F.split(known, SPACE, -1), "")).cast("long").alias("n_words"),
        F.length(F.regexp_replace(known, SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count(known, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.array_remove(F.split(known, SPACE, -1), "")).cast("long").alias("n_repeat_words"),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [
        F.log(words), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars),
        F.col("n_dup_lines") / words * 10, F.col("n_repeat_words") / words,
    ]


def _grouped(rows: DataFrame, language: str, source: str) -> DataFrame:
    """Label each row with the group its estimate comes from."""
    sizes = rows.groupBy(F.col(language).alias("_l"), F.col(source).alias("_s")).agg(F.count("*").alias("_n"))
    own = F.col("_n") >= SMALLEST
    pools = sizes.filter(~own).groupBy("_l").agg(F.sum("_n").alias("_pool")).withColumnRenamed("_l", "_k")
    label = F.when(own, F.concat(_text("_l"), F.lit("/"), _text("_s"))).when(F.col("_pool") >= SMALLEST, _text("_l")).otherwise("*")
    named = store(sizes.join(pools, F.col("_l").eqNullSafe(F.col("_k")), "left").select("_l", "_s", label.alias("_group")), "quality-groups")
    match = F.col(language).eqNullSafe(F.col("_l")) & F.col(source).eqNullSafe(F.col("_s"))
    return rows.join(named, match).drop("_l", "_s")


def _text(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("v"), F.col(name).cast("string")), F.lit("-"))


def _start(rows: DataFrame) -> DataFrame:
    """Per group: median and quartile range of each part, from counts in fixed classes a quarter floor wide."""
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(x) / (f / 4)).alias("c")) for i, (x, f) in enumerate(zip(PARTS, FLOORS))])).alias("e")
    # stored, so that a group's classes are summed over many tasks before they meet in one
    counts = store(rows.select("_group", parts).groupBy("_group", "e.i", "e.c").agg(F.count("*").alias("n")), "quality-counts")
    upto = Window.partitionBy("_group", "i").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("n").over(upto) / F.sum("n").over(Window.partitionBy("_group", "i"))
    at = counts.withColumn("share", share)
    ranks = [F.min(F.when(F.col("share") >= q, F.col("c"))).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
    found = at.groupBy("_group", "i").agg(*ranks)
    width = F.array(*[F.lit(f / 4) for f in FLOORS])
    middle, spread = (F.col("q50") + 0.5) * F.get(width, F.col("i")), (F.col("q75") - F.col("q25")) / 1.349 * F.get(width, F.col("i"))
    cells = [F.max(F.when(F.col("i") == i, middle)).alias(f"m{i}") for i in range(P)]
    cells += [F.sqrt(F.max(F.when(F.col("i") == i, spread)) ** 2 + f * f).alias(f"l{i}{i}") for i, f in enumerate(FLOORS)]
    zeros = [F.lit(0.0).alias(f"l{i}{j}") for i in range(P) for j in range(i)]
    return store(found.groupBy("_group").agg(*cells).select("*", *zeros).withColumn("log_det", _log_det()), "quality-start")


def _distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance to the row's group, by forward substitution with the Cholesky factor.

    The hash as a second key keeps a later aggregate by group from taking over the join's partitions, in which a
    group's rows would meet before they are summed; it also leaves a hot group to be split.
    """
    sides = estimates.withColumnRenamed("_group", "_g").withColumn("_h", F.xxhash64("_g"))
    out = rows.join(sides, (F.col("_group") == F.col("_g")) & (F.xxhash64("_group") == F.col("_h")))
    for i, x in enumerate(PARTS):
        rest = F.col(x) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"_z{j}")
        out = out.withColumn(f"_z{i}", rest / F.col(f"l{i}{i}"))
    squares = [F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(P)]
    return out.withColumn("distance", sum(squares[1:], squares[0])).drop("_g", "_h", *[f"_z{i}" for i in range(P)], *[c for c in estimates.columns if c != "_group"])


#: Sums that an estimate is made of.
SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}{j}" for i in range(P) for j in range(i + 1)]]
#: What an estimate holds: means, a Cholesky factor, and the logarithm of its determinant.
ESTIMATE = [*[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i in range(P) for j in range(i + 1)], "log_det"]


def _sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(PARTS)],
        *[F.sum(F.col(PARTS[i]) * F.col(PARTS[j])).alias(f"s{i}{j}") for i in range(P) for j in range(i + 1)],
    ]


def _estimate(sums: DataFrame, consistency: float) -> DataFrame:
    """Mean, Cholesky factor and determinant per group from its sums."""
    out = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(P)})
    for i in range(P):
        for j in range(i + 1):
            value = consistency * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + FLOORS[i] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # rounding may leave a hair less than the floor
            value = F.sqrt(F.greatest(value, F.lit(FLOORS[i] ** 2 / 4))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    out = out.withColumn("log_det", _log_det())
    return out.select("_group", *ESTIMATE)


def _log_det() -> Column:
    logs = [2 * F.log(F.col(f"l{i}{i}")) for i in range(P)]
    return sum(logs[1:], logs[0])


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Mean and Cholesky factor from the closest rows of each group."""
    # eight classes per doubling of the distance
    near = _distances(rows, estimates).withColumn("_class", F.floor(8 * F.log2(F.greatest("distance", F.lit(1e-9)))))
    classes = store(near.groupBy("_group", "_class").agg(*_sums()), "quality-classes")
    before = F.sum("n").over(Window.partitionBy("_group").orderBy("_class")) - F.col("n")
    wanted = F.ceil(SUBSET * F.sum("n").over(Window.partitionBy("_group")))
    kept = classes.withColumn("_before", before).withColumn("_wanted", wanted).filter("_before < _wanted")
    return _estimate(kept.groupBy("_group").agg(*[F.sum(c).alias(c) for c in SUMS]), CONSISTENCY)


def _settled(rows: DataFrame, start: DataFrame) -> DataFrame:
    """Concentration steps from a start until no group's determinant falls any more; each group keeps its smallest.

    The start is an estimate of another kind, so determinants are compared from the second step on.
    """
    best = store(_step(rows, store(_step(rows, start), "quality-estimates")), "quality-estimates")
    for _ in range(MOST_STEPS):
        found = store(_smaller(best, _step(rows, best)), "quality-estimates")
        # determinants fall, so this ends; most groups stand still after a few steps
        if found.filter("fell").isEmpty():
            return best
        best = found.drop("fell")
    raise RuntimeError(f"estimates not settled after {MOST_STEPS} steps")


def _smaller(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per group the estimate with the smaller determinant, and whether that is the second one by more than ``FALL``."""
    other = b.select(F.col("_group"), *[F.col(c).alias(f"_{c}") for c in ESTIMATE])
    fell = F.col("_log_det") < F.col("log_det") - FALL
    chosen = [F.when(fell, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ESTIMATE]
    return a.join(other, "_group").select("_group", fell.alias("fell"), *chosen)


def _minimum(rows: DataFrame) -> DataFrame:
    """The smallest determinant that concentration reaches from two starts: medians and quartile ranges, and all rows.

    Both starts take their steps together, each with a label of its own for the group.
    """
    everything = store(_estimate(rows.groupBy("_group").agg(*_sums()), 1.0), "quality-sums")

    def labelled(estimates: DataFrame, mark: str) -> DataFrame:
        return estimates.withColumn("_group", F.concat(F.lit(mark), "_group"))

    both = rows.withColumn("_group", F.explode(F.array(F.concat(F.lit("r"), "_group"), F.concat(F.lit("p"), "_group"))))
    found = _settled(both, labelled(_start(rows), "r").unionByName(labelled(everything, "p")))
    own = F.substring("_group", 2, 1 << 30)
    robust, plain = (found.filter(F.col("_group").startswith(mark)).withColumn("_group", own) for mark in "rp")
    return store(_smaller(robust, plain).drop("fell"), "quality-minimum")


def quality(df: DataFrame, text: str, language: str, source: str, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns of every row with its statistics, base_failed, distance and kept.

    Rows that fail the base rules are not kept, have no distance and take no part in the estimates. A null language
    or source is a value of its own. Null and empty texts have no words and fail. Groups of fewer than ``SMALLEST``
    rows are pooled over the language, and what is left over all languages; a pool of any size gets an estimate, as
    the floors keep it regular. Repeated rows count as often as they occur. An empty table gives no rows. Kept
    columns with the names of the new ones are replaced.
    """
    new = {*STATISTICS, *PARTS, "base_failed", "distance", "kept"}
    keep = [c for c in keep if c.lower() not in new]
    l, s = "_language", "_source"
    rows = df.select(*keep, F.col(language).alias(l), F.col(source).alias(s), *statistics(F.col(text)))
    rows = rows.withColumn("base_failed", base_failed())
    rows = store(rows.withColumns(dict(zip(PARTS, vector()))), "quality-rows")
    passed = store(_grouped(rows.filter("not base_failed"), l, s), "quality-passed")
    far = _distances(passed, _minimum(passed)).withColumn("kept", F.col("distance") <= CUTOFF)
    short = rows.filter("base_failed").withColumn("distance", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    out = [*keep, *STATISTICS, "base_failed", "distance", "kept"]
    return far.select(*out).unionByName(short.select(*out))
