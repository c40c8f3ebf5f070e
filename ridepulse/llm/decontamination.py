"""Benchmark decontamination by winnowing.

Both sides hash every run of ``GRAM`` words and keep the smallest hash of every ``reach`` neighbouring runs. Any
``window`` words that a document shares with an item hold the same hashes on both sides, so they share a kept one:
no shared window can be missed. Kept hashes, each once per text, are joined and name the texts that may hold an item. In
those alone every window is hashed as a whole and joined with the items' windows; windows that occur are extended to the
spans they cover. A text has one row per position at most, however often a phrase repeats in it or in the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, let, store, word_grams

#: Words in a hashed run.
GRAM = 5
#: Characters between words once A-Z is lower case, and in any case (fixed values).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text in lower case; null has none."""
    known = F.coalesce(text, F.lit(""))
    # the built-in lower case is much faster and the same on plain ASCII
    lower = F.when(F.length(known) == F.octet_length(known), F.lower(known)).otherwise(ascii_lower(known))
    return F.array_remove(F.split(lower, BETWEEN, -1), "")


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), ANY_BETWEEN, -1), "")).cast("long")


def kept_hashes(words: Column, gram: int, reach: int) -> Column:
    """The distinct hashes kept by winnowing: the smallest of any ``reach`` neighbouring runs of ``gram`` words."""

    def kept(hashes: Column) -> Column:
        starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (reach - 1), F.lit(0)))
        return F.transform(starts, lambda h, i: F.array_min(F.slice(hashes, i + 1, reach)))

    return F.array_distinct(let(word_grams(words, gram), kept) if reach > 1 else word_grams(words, gram))


def _tagged(hashes: Column, n: int) -> Column:
    """Hashes of runs for items of one length, apart from those of other lengths."""
    return F.transform(hashes, lambda h: F.xxhash64(F.lit(n), h))


def _seeds(words: Column, lengths: list[int], window: int) -> Column:
    """The hashes that a text has in common with an item of one of the lengths if it holds a window of it."""
    found = []
    for n in lengths:
        gram, reach = (GRAM, n - GRAM + 1) if n == window and n > GRAM else (n, 1)
        found.append(_tagged(kept_hashes(words, gram, reach), n))
    return F.concat(*found)


def _windows(words: Column, n: int) -> Column:
    """Every window of ``n`` words: its position, and 96 bits that name it."""

    def at(word: Column, i: Column) -> Column:
        run = [F.get(words, i + k) for k in range(n)]
        return F.struct(i.alias("at"), F.xxhash64(*run).alias("h"), F.hash(*run).alias("g"))

    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0))), at)


def _all_windows(rows: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, n, at, h, g) of every window of each length; ``rows`` has the key, words and, for items, their own length."""
    own = F.col("n") if "n" in rows.columns else None
    lists = []
    for n in lengths:
        found = _windows(F.col("words"), n) if own is None else F.when(own == n, _windows(F.col("words"), n))
        lists.append(F.struct(F.lit(n).alias("n"), found.alias("w")))
    each = rows.select(key, F.inline(F.array(*lists)))
    return each.select(key, "n", F.inline("w"))


def shared_windows(texts: DataFrame, items: DataFrame, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """Windows of texts that occur in an item (digest, start, end: words, end exclusive), and (digest, item) pairs.

    ``texts`` has digest and text, ``items`` has item and text. A window is ``window`` words long, or as long as the
    whole item if that is shorter. Items without words never match.
    """
    items = items.select("item", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
    items = store(items.withColumn("n", F.least(F.size("words"), F.lit(window))), "items")
    # at most ``window`` lengths, whatever the size of the benchmark
    lengths = sorted(row.n for row in items.select("n").distinct().collect())
    if not lengths:
        none = texts.sparkSession.createDataFrame([], "digest binary, start int, end int")
        return none, none.select("digest", F.lit("").alias("item"))
    of_length = [F.when(F.col("n") == n, _seeds(F.col("words"), [n], window)) for n in lengths]
    wanted = store(items.select(F.explode(F.coalesce(*of_length)).alias("hash")).distinct(), "item-seeds")
    seeds = texts.select("digest", F.explode(let(words_of(F.col("text")), lambda w: _seeds(w, lengths, window))).alias("hash"))
    maybe = store(seeds.join(wanted, "hash", "left_semi").select("digest").distinct(), "maybe")
    chosen = texts.join(maybe, "digest", "left_semi").dropDuplicates(["digest"])
    bodies = store(chosen.select("digest", words_of(F.col("text")).alias("words")), "candidate-words")
    of_items = store(_all_windows(items, "item", lengths).select("item", "n", "h", "g").distinct(), "item-windows")
    name = ["n", "h", "g"]
    hits = _all_windows(bodies, "digest", lengths).join(of_items.select(*name).distinct(), name, "left_semi")
    hits = store(hits, "window-hits")
    pairs = hits.select("digest", *name).distinct().join(of_items, name).select("digest", "item").distinct()
    spans = hits.select("digest", F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("end")).distinct()
    return spans, pairs


def contamination(df: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str, window: int = 13) -> DataFrame:
    """All rows of ``df`` with n_words, n_hit, items (ids as sorted strings) and contaminated.

    A word is hit if it lies in a window of an item that occurs in the text; a row is contaminated if at least one
    word in twenty is hit. Equal texts are compared once. Null and empty texts have no words and are clean; a null
    item id has its words hit but is not listed; repeated items count once. An empty benchmark leaves all rows clean,
    an empty ``df`` gives no rows. Columns of ``df`` with the names of the new ones are replaced.
    """
    new = ["n_words", "n_hit", "items", "contaminated"]
    rows = df.drop(*new)
    digest = fresh([*df.columns, *new], "_digest")
    address = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    texts = df.select(address.alias("digest"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text"))
    # an id that is null still has to meet its own words
    spans, pairs = shared_windows(texts, items.withColumn("item", F.coalesce(F.concat(F.lit("i"), "item"), F.lit("-"))), window)
    upto = Window.partitionBy("digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    new_words = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(upto), F.lit(0))), F.lit(0))
    words_hit = spans.withColumn("new_words", new_words).groupBy("digest").agg(F.sum("new_words").alias("n_hit"))
    named = F.array_sort(F.collect_set(F.when(F.col("item") != "-", F.substring("item", 2, 1 << 30)))).alias("items")
    hits = words_hit.join(pairs.groupBy("digest").agg(named), "digest")
    hits = store(hits.select(F.col("digest").alias(digest), F.col("n_hit").cast("long").alias("n_hit"), "items"), "contamination")
    counted = rows.withColumn(digest, address).withColumn("n_words", count_words(F.col(text)))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(hits, digest, "left").select(
        *rows.columns, "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
