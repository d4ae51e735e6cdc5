"""Near-copies by the Jaccard similarity of word shingles.

Documents whose sets of shingles have a similarity of ``least`` or more are linked, and linked
documents form groups.

* **Fingerprints first.** The trie join of ``simhash`` links the SimHash fingerprints of the
  documents, and each document is compared with one of its linked ones, by its texts. It finds the
  close copies. It cannot decide the others: two texts at 0.8 differ in about ten of 64 bits, and it
  reports roots of chains, of which a pair that is similar need not be one. So further candidates
  come from MinHash; documents that are of one group already aren't compared again.
* **Candidates.** Of ``BANDS`` keys, each a hash of the ``ROWS`` smallest values of the shingles
  under as many orders, two documents share one with probability 1 - (1 - s ** ROWS) ** BANDS. At a
  similarity of 0.8 a pair is missed five times in 100 million, above it less.
* **Decision.** Every candidate pair is decided by its texts, exactly. Equal sets are one class from
  the start, and pairs whose sizes rule the similarity out are dropped unseen.
* **No pairs of a group.** First all classes of a key are compared with one of them, and groups are
  formed. Only classes of keys that still hold several groups go on, to an exact prefix-filtered join:
  their shingles are ordered by how many of these classes hold them, the rarest first. Two sets
  that are similar enough share a shingle among the first ones of both, where the smaller set's
  share is ``2 least / (1 + least)`` short of whole and the larger one's ``least``. A shingle of one
  class finds nobody, so many texts of one template that all differ by more than the threshold
  allows have nothing but their own shingles there, and make no pairs.

Null text counts as empty; texts without words are one class, fewer words than a shingle are one
shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow, map_batches
from veracast.llm.simhash import _hashes, _links, _signed, components, fingerprints_of
from veracast.sources.scratch import stage

BANDS, ROWS = 32, 4
#: Words of a fingerprint's shingles, and bits in which linked fingerprints differ at most.
PRINT_WORDS, PRINT_BITS = 3, 2
#: Shingles that are hashed under all orders at once.
CHUNK = 4_096
_FACTORS = np.random.default_rng(5).integers(1 << 63, size=(BANDS * ROWS, 1), dtype=np.uint64) * 2 + 1


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    return np.unique(_hashes(text or "", shingle))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are equal."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed key for each band; none for a text without words."""
    if not len(hashes):
        return []
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    mixed = hashes ^ (hashes >> np.uint64(31))
    for first in range(0, len(mixed), CHUNK):
        np.minimum(least, (mixed[first : first + CHUNK] * _FACTORS).min(1), out=least)
    bands = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(bands)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def _sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """(place, class, n, print, bands): ``class`` names a set of ``n`` shingles."""

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            sets = [shingle_set(t, shingle) for t in texts]
            prints = [fingerprints_of(t, PRINT_WORDS)[0] for t in texts]
            names = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64)
            columns = [
                batch.column(0),
                pa.array(names.view(np.int64)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(_signed(prints), pa.int64()),
                pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["place", "class", "n", "print", "bands"])

        return work

    kind = dict(docs.dtypes)["place"]
    rows = docs.select("place", F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, build, f"place {kind}, class long, n long, print long, bands array<long>")


def _fit(n: str, m: str, least: float) -> Column:
    """Sets of these sizes can be that similar."""
    return F.least(n, m) >= F.lit(least) * F.greatest(n, m) - 1e-9


def print_pairs(classes: DataFrame, least: float) -> DataFrame:
    """(a, b): each of ``classes`` (class, n, print) with the least one that its fingerprint reaches."""
    prints = classes.select(F.lit(0).alias("table"), "print").distinct()
    rooted = components(stage(_links(prints, PRINT_BITS), "print-links"))
    named = classes.join(rooted, classes["print"] == rooted["node"], "left")
    named = named.select("class", "n", F.coalesce("root", "print").alias("reached"))
    center = named.groupBy("reached").agg(
        F.min(F.struct("class", "n")).alias("center"), F.count("*").alias("classes")
    )
    met = named.join(center.where("classes > 1"), "reached")
    met = met.where((F.col("class") != F.col("center.class")) & _fit("n", "center.n", least))
    return met.select(F.col("class").alias("a"), F.col("center.class").alias("b"))


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) of classes whose texts are that similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, None  # pairs come sorted by b
        for batch in batches:
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(a)):
                if b[i] != held:
                    held, known = b[i], shingle_set(text_b[i], shingle)
                if jaccard(shingle_set(text_a[i], shingle), known) >= least:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    of_a = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "text_a", "text_b")
    return in_arrow(both, run, "a long, b long")


def _prefix_pairs(classes: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b): pairs of ``classes`` (class, n, root) of different roots that may be similar enough.

    All that are similar enough are among them.
    """

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
            told = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([batch.column(0), told], ["class", "shingles"])

        return work

    open_texts = texts.join(classes.select("class"), "class", "left_semi").select("class", "text")
    sets = stage(map_batches(open_texts, build, "class long, shingles array<long>"), "open-shingles")
    tokens = sets.select("class", F.explode("shingles").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("classes")).where("classes > 1")
    # Written first, so that the join's sides are plain shuffles, which Spark splits at hot keys.
    shared = stage(shared, "shared-shingles")
    held = tokens.join(shared, "token").groupBy("class").agg(
        F.array_sort(F.collect_list(F.struct("classes", "token"))).alias("shared")
    )
    rows = classes.join(held, "class").withColumn("own", F.col("n") - F.size("shared"))

    def first_ones(part: float) -> DataFrame:
        """Shared shingles among the first of each set; its own ones come before them."""
        # A sum of binary noise must not shorten a prefix.
        reach = F.col("n") - F.ceil(F.col("n") * part - 1e-9) + 1 - F.col("own")
        some = F.slice("shared", 1, F.greatest(reach, F.lit(0)).cast("int"))
        return rows.select("class", "n", "root", "own", F.posexplode(some).alias("at", "s")).select(
            F.col("s.token").alias("token"),
            # Shingles from this one on.
            F.struct("n", "class", "root", (F.col("n") - F.col("own") - F.col("at")).alias("left")).alias("row"),
        )

    smaller = stage(first_ones(2 * least / (1 + least)), "indexed-shingles")
    larger = stage(first_ones(least), "probing-shingles").withColumnRenamed("row", "other")
    met = smaller.join(larger, "token").where(
        "(row.n < other.n OR (row.n = other.n AND row.class < other.class)) AND row.root <> other.root"
    )
    met = met.where(F.col("row.n") >= F.lit(least) * F.col("other.n") - 1e-9)
    # The first shingle that two sets share has all others that they share after it.
    needed = F.lit(least / (1 + least)) * (F.col("row.n") + F.col("other.n")) - 1e-9
    met = met.where(F.least("row.left", "other.left") >= needed)
    pair = [F.col("row.class"), F.col("other.class")]
    return met.select(F.least(*pair).alias("a"), F.greatest(*pair).alias("b")).distinct()


def similar_groups(docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """(place, root) of each row of ``docs`` (place, text); rows of a group have one root.

    ``place`` is never null and differs where texts differ.
    """
    sketched = stage(_sketched(docs, shingle), "sketches")
    one = sketched.groupBy("class").agg(F.min(F.struct("place", "n", "print", "bands")).alias("one"))
    classes = stage(one.select("class", "one.*"), "shingle-classes")
    by_print = stage(print_pairs(classes.select("class", "n", "print"), least), "print-pairs")
    keys = classes.select("class", "n", F.explode("bands").alias("key"))
    met = keys.groupBy("key").agg(
        F.min(F.struct("class", "n")).alias("center"), F.count("*").alias("classes")
    )
    # Written first, so that the join's sides are plain shuffles, which Spark splits at hot keys.
    met = stage(met.where("classes > 1").select("key", "center"), "shared-bands")
    entries = stage(keys.join(met, "key"), "band-entries")

    named = F.explode(F.array("a", "b")).alias("class")
    wanted = entries.select("class").unionByName(by_print.select(named)).distinct()
    places = classes.select("class", "place").join(wanted, "class", "left_semi")
    # A row that repeats both id and text has the place of the other.
    texts = docs.select("place", "text").join(places, "place").groupBy("class")
    texts = stage(texts.agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "class-texts")
    print_edges = stage(_verified(by_print, texts, shingle, least), "print-edges")
    copies = stage(components(print_edges), "print-roots")

    to_center = entries.where(F.col("class") != F.col("center.class"))
    to_center = to_center.where(_fit("n", "center.n", least))
    to_center = to_center.select(F.col("class").alias("a"), F.col("center.class").alias("b"))
    of_a, of_b = (
        copies.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in "ab"
    )
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    to_center = to_center.distinct().join(of_a, "a", "left").join(of_b, "b", "left").where(apart)
    to_center = stage(to_center.select("a", "b"), "center-pairs")
    center_edges = stage(_verified(to_center, texts, shingle, least), "center-edges")
    edges = print_edges.unionByName(center_edges)

    rooted = components(edges)
    found = entries.join(rooted, entries["class"] == rooted["node"], "left")
    found = stage(
        found.select("key", "class", "n", "center", F.coalesce("root", "class").alias("root")),
        "rooted-entries",
    )
    mixed = found.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = stage(mixed.where("low < high").select("key"), "mixed-bands")
    # Pairs with the center are decided.
    rest = stage(
        found.join(mixed, "key").where(F.col("class") != F.col("center.class")), "mixed-entries"
    )
    across = _prefix_pairs(rest.select("class", "n", "root").distinct(), texts, shingle, least)
    decided = to_center.select(F.col("b").alias("a"), F.col("a").alias("b"))  # a center is the least
    across = across.join(decided, ["a", "b"], "left_anti")
    more = _verified(stage(across, "rest-pairs"), texts, shingle, least)
    rooted = stage(components(edges.unionByName(more)), "similar-roots")
    named = sketched.select("place", "class").join(rooted, sketched["class"] == rooted["node"], "left")
    return named.select("place", F.coalesce("root", "class").alias("root"))
