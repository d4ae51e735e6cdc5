"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter one), seen as the set
of its shingles. A text holds a window exactly where it holds all of its shingles, in their places.

1. One pass over the texts finds where benchmark shingles occur. Each match keeps the words
   around it; texts are not read or moved again.
2. Shingles are ordered by rarity, by their number of matches in all texts. A window has to
   match on the first of that order: with all shingles required, that prefix is enough.
3. The prefix match fixes where the window would lie. Bounds on place and length drop those that
   would start before or end after the text; the words around the match decide exactly.

The benchmark's shingles are broadcast up to ``BROADCAST_SHINGLES`` (counted first), and
shuffled beyond. Matches group by document; no pairs of documents and items are formed.

Null text has no words. An item without words has no windows; a null item_id takes part in hits but
has no id to report; equal item_ids count once. Rows that share an id are judged each by their own
text. An empty benchmark marks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.llm.common import row_key
from veracast.sources.scratch import stage

WINDOW, SHINGLE = 10, 5
BROADCAST_SHINGLES = 2_000_000
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case and nothing else changed; none for null."""
    text = F.coalesce(text, F.lit(""))
    # Plain ASCII is as long in bytes as in characters; there ``lower`` does the same, faster.
    plain = F.length(text) == F.octet_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _NOT_WORD), "")


def _windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, window, n, words): each distinct window of each item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("all"))
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - WINDOW, F.lit(0))))
    cut = items.where(F.size("all") > 0).select("item_id", "all", start.alias("at"))
    own = cut.select("item_id", F.slice("all", F.col("at") + 1, WINDOW).alias("words"))
    return own.distinct().select(
        "item_id", "words", F.size("words").alias("n"), F.xxhash64("words").alias("window")
    )


def _hash(words_of: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words_of, at + i) for i in range(size)])


def _shingles(windows: DataFrame) -> DataFrame:
    """(words, n, size, at, shingle): the shingles of each distinct window, by place."""
    distinct = windows.select("words", "n").distinct()
    size = F.least(F.col("n"), F.lit(SHINGLE))
    at = F.explode(F.sequence(F.lit(0), F.col("n") - size))
    cut = distinct.select("words", "n", size.alias("size"), at.alias("at"))
    shingle = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        shingle = F.when(F.col("size") == k, _hash(F.col("words"), F.col("at"), k)).otherwise(
            shingle
        )
    return cut.withColumn("shingle", shingle)


def _matches(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Where texts hold benchmark shingles, and one row for each text with its number of words.

    (doc_id, key, n_words, at, shingle, around): the row of a text has no shingle unless one
    starts at its first word. ``around`` has the words from ``WINDOW`` before to after the match.
    """
    sizes = [r["size"] for r in shingles.select("size").distinct().collect()]  # SHINGLE at most
    wanted = stage(shingles.select("shingle", "size").distinct(), "benchmark-shingles")
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", row_key(docs).alias("key"), words(F.col("text")).alias("words"))
    n = F.size("words")
    at = F.posexplode_outer("words").alias("at", "word")
    spots = texts.select("doc_id", "key", "words", n.alias("n_words"), at)
    hashes = [
        F.when(F.col("at") + k <= F.col("n_words"), _hash(F.col("words"), F.col("at"), k))
        for k in sorted(sizes)
    ]
    if len(hashes) == 1:
        spots = spots.withColumn("h", hashes[0]).withColumn("k", F.lit(sizes[0]))
    elif hashes:  # short items have shorter shingles
        each = [F.struct(F.lit(k).alias("k"), h.alias("h")) for k, h in zip(sorted(sizes), hashes)]
        spots = spots.withColumn("s", F.explode(F.array(*each))).select("*", "s.h", "s.k").drop("s")
    else:
        spots = spots.withColumn("h", F.lit(None).cast("long")).withColumn("k", F.lit(0))
    found = spots.join(
        wanted, (F.col("h") == F.col("shingle")) & (F.col("k") == F.col("size")), "left"
    )
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    first = first & (F.col("k") == (min(sizes) if sizes else 0))
    from_word = F.greatest(F.col("at") - WINDOW, F.lit(0))
    return found.where(F.col("shingle").isNotNull() | first).select(
        "doc_id",
        "key",
        "n_words",
        first.alias("is_text"),
        F.col("at"),
        "shingle",
        "size",
        F.when(
            F.col("shingle").isNotNull(),
            F.slice("words", from_word + 1, F.lit(2 * WINDOW)),
        ).alias("around"),
        from_word.alias("from_word"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, key, n_words, n_hit, n_items, item_ids (sorted).

    ``key`` is the hash of the text; a row of the result stands for one row of ``docs``.
    """
    windows = stage(_windows(benchmark), "benchmark-windows")
    shingles = stage(_shingles(windows), "benchmark-window-shingles")
    matches = stage(_matches(docs, shingles), "benchmark-matches")
    hits = matches.where("shingle IS NOT NULL")
    rarity = hits.groupBy("shingle", "size").agg(F.count("*").alias("seen"))
    # A window with a shingle that no text has can't occur: its rarest has no match to join.
    ranked = shingles.join(rarity, ["shingle", "size"], "left").select(
        "words", "n", "size", "shingle", "at", F.coalesce("seen", F.lit(0)).alias("seen")
    )
    prefix = ranked.groupBy("words", "n", "size").agg(
        F.min(F.struct("seen", "shingle", "at")).alias("rarest")
    )
    prefix = prefix.where("rarest.seen > 0").select(
        "words", "n", "size", "rarest.shingle", F.col("rarest.at").alias("offset")
    )
    prefix = stage(prefix, "benchmark-prefixes")
    if prefix.count() <= BROADCAST_SHINGLES:
        prefix = F.broadcast(prefix)
    start = (F.col("at") - F.col("offset")).alias("start")
    candidates = hits.join(prefix, ["shingle", "size"]).select(
        "doc_id", "key", "n_words", start, "n", "words", "around", "from_word"
    )
    inside = candidates.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
    held = F.slice("around", F.col("start") - F.col("from_word") + 1, F.col("n"))
    true = inside.where(held == F.col("words")).select(
        "doc_id", "key", "start", (F.col("start") + F.col("n")).alias("stop"), "words"
    )
    true = stage(true.distinct(), "benchmark-hits")
    before = Window.partitionBy("doc_id", "key").orderBy("start", "stop")
    reached = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(
        F.col("stop") - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0))), F.lit(0)
    )
    covered = (
        true.select("doc_id", "key", "start", "stop")
        .distinct()
        .withColumn("fresh", fresh)
        .groupBy("doc_id", "key")
        .agg(F.sum("fresh").alias("n_hit"))
    )
    owners = windows.select("words", F.col("item_id").cast("string").alias("item"))
    by_text = (
        true.select("doc_id", "key", "words")
        .distinct()
        .join(owners, "words")
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    per_text = covered.join(
        by_text.withColumnsRenamed({"doc_id": "i", "key": "k"}),
        F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")),
    ).select("i", "k", "n_hit", "item_ids")
    texts = matches.where("is_text").select("doc_id", "key", "n_words")
    return texts.join(
        per_text, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left"
    ).select(
        "doc_id",
        "key",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
