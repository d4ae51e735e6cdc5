"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has one bit for each of 64 places: set if over half the shingles' hashes set it.
Documents link when their fingerprints differ in at most ``budget`` bits; the linked documents
form components.

* **Trie self-join.** The distinct fingerprints form a binary trie. Pairs of nodes of equal depth
  are traversed together: differing bits add up, and a pair whose count exceeds the budget is
  dropped with everything below it. Of ``budget + 1`` blocks of bits one is equal in any linking
  pair, so each fingerprint goes into ``budget + 1`` tries, each with another block on top, and only
  node pairs that start with an equal block are followed. Tries are dealt by that block.
* **No unbounded group.** A block with more than ``NODE_ROWS`` fingerprints is split into the pairs
  of its child nodes ``SPLIT_BITS`` further down, again and again, before any task takes it.
* **No pairs of a group.** A task reports each fingerprint's root in its part of the trie, not the
  pairs. Equal fingerprints are one entry from the start, however many documents have them.
* **Components** come from star contractions over these few edges, staged each round.

Null text counts as empty; no words give the fingerprint zero, fewer words than a shingle one
shingle. Rows that share an id are each kept; null ids never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow, map_batches
from veracast.sources.scratch import stage

BITS = 64
#: Fingerprints that one task joins as one pair of trie nodes, and the depth of a split.
NODE_ROWS, SPLIT_BITS = 100_000, 8
#: Node pairs followed at once, and rows that a task joins at once.
FRONT, STREAM_ROWS = 100_000, 100_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BIT_OF_BYTE = np.array([[b >> i & 1 for i in range(8)] for b in range(256)], dtype=float)
#: Odd factors that turn one hash into those of further, independent fingerprints.
_FACTORS = np.array([2 * i * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1 for i in range(64)], np.uint64)


def _hashes(text: str, shingle: int) -> np.ndarray:
    words = text.encode("utf-8", "replace").translate(_FOLD).split()  # splits at ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= shingle:
        shingles: list[bytes] = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    found = map(xxhash.xxh64_intdigest, shingles, repeat(42))
    return np.fromiter(found, dtype=np.uint64, count=len(shingles))


def _majority(hashes: np.ndarray) -> list[int]:
    """For each row of ``hashes``, the number whose bits are set in over half of its hashes."""
    rows, n = hashes.shape
    bytes_of = hashes.view(np.uint8).reshape(rows, n, 8)  # little-endian
    place = np.arange(8 * rows, dtype=np.int32).reshape(rows, 1, 8) * 256
    seen = np.bincount((bytes_of + place).ravel(), minlength=8 * 256 * rows)
    ones = seen.reshape(8 * rows, 256).astype(float) @ _BIT_OF_BYTE  # exact: counts are small
    bits = (2 * ones > n).reshape(rows, 64)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().tolist()


def fingerprints_of(text: str, shingle: int, tables: int = 1) -> list[int]:
    """``tables`` fingerprints; the first is that of the plain hashes."""
    hashes = _hashes(text, shingle)
    if not len(hashes):
        return [0] * tables
    factors = _FACTORS[1:tables, None]
    mixed = (hashes ^ (hashes >> np.uint64(31))) * factors
    mixed ^= mixed >> np.uint64(29)
    return _majority(np.vstack([hashes[None], mixed]))


def _signed(values: list[int]) -> list[int]:
    return [v - (1 << 64) if v >> 63 else v for v in values]


def fingerprints(docs: DataFrame, carried: list[str], shingle: int, tables: int = 1) -> DataFrame:
    """``carried`` columns and ``prints``: fingerprints as signed 64-bit numbers."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), "prints array<long>"])

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(len(carried)).to_pylist()
            made = [_signed(fingerprints_of(t, shingle, tables)) for t in texts]
            columns = [*batch.columns[: len(carried)], pa.array(made, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, [*carried, "prints"])

        return work

    rows = docs.select(*carried, F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, build, schema)


# -- the trie self-join ------------------------------------------------------------------


def _halves(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where each node [lo, hi) of sorted ``keys`` splits at the bit below ``depth``."""
    bit = np.uint64(1 << (BITS - 1 - depth))
    above = np.uint64((1 << BITS) - (1 << (BITS - depth)))  # the bits that a node shares
    return np.clip(np.searchsorted(keys, (keys[lo] & above) | bit), lo, hi)


def linked_places(keys: np.ndarray, start: np.ndarray, depth: int, budget: int) -> Iterator[tuple]:
    """Places (a, b) of sorted distinct ``keys`` that differ in at most ``budget`` bits.

    ``start`` has node pairs at ``depth`` as rows (a from, a to, b from, b to, differing bits).
    """
    waiting = [(depth, start)]
    while waiting:
        depth, front = waiting.pop()
        if len(front) > FRONT:
            half = len(front) // 2
            waiting += [(depth, front[half:]), (depth, front[:half])]
            continue
        a0, a1, b0, b1, used = front.T
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            x, y = a0[single], b0[single]
            apart = x != y
            x, y = x[apart], y[apart]
            close = np.bitwise_count(keys[x] ^ keys[y]) <= budget
            yield x[close], y[close]
            a0, a1, b0, b1, used = front[~single].T
        if not len(a0) or depth == BITS:
            continue
        am, bm = _halves(keys, a0, a1, depth), _halves(keys, b0, b1, depth)
        same = a0 == b0  # a node with itself: its cross pair counts once
        children = np.concatenate(
            [
                np.stack([a0, am, b0, bm, used], 1),
                np.stack([am, a1, bm, b1, used], 1),
                np.stack([a0, am, bm, b1, used + 1], 1),
                np.stack([am, a1, b0, bm, used + 1], 1)[~same],
            ]
        )
        alone = (children[:, 0] == children[:, 2]) & (children[:, 1] - children[:, 0] == 1)
        there = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])
        waiting.append((depth + 1, children[there & ~alone & (children[:, 4] <= budget)]))


def _roots(n: int, pairs: Iterator[tuple]) -> np.ndarray:
    """The smallest place that each of ``n`` places is linked to, itself included."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def _turned(keys: np.ndarray, by: int) -> np.ndarray:
    """Bits rotated to the left, so that a block comes on top."""
    if not by:
        return keys
    return (keys << np.uint64(by)) | (keys >> np.uint64(BITS - by))


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``budget + 1`` blocks."""
    cuts = [BITS * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _tries(prints: DataFrame, budget: int) -> DataFrame:
    """(kind, depth, turned): each fingerprint once a trie; ``kind`` is the table and the trie."""
    blocks = _blocks(budget)
    tries = [
        F.struct(
            (F.col("table") * len(blocks) + i).alias("kind"),
            F.lit(width).alias("depth"),
            (
                F.shiftleft("print", first).bitwiseOR(F.shiftrightunsigned("print", BITS - first))
                if first
                else F.col("print")
            ).alias("turned"),
        )
        for i, (first, width) in enumerate(blocks)
    ]
    return prints.select("table", F.explode(F.array(*tries)).alias("t")).select("t.*")


def _top(bits: str) -> Column:
    """The node that ``turned`` lies in, ``bits`` deep."""
    return F.expr(f"shiftrightunsigned(turned, {BITS} - {bits})")


def _crowded(rows: DataFrame) -> DataFrame | None:
    """(kind, top) of the nodes with more than ``NODE_ROWS`` fingerprints; None if there are none.

    Nodes are counted one by one only if the few nodes ``SPLIT_BITS`` deep, which hold them, are
    that large.
    """

    def large(depth: str) -> DataFrame:
        counted = rows.groupBy("kind", _top(depth).alias("top")).agg(F.count("*").alias("n"))
        return counted.where(F.col("n") > NODE_ROWS).select("kind", "top")

    if large(f"least(depth, {SPLIT_BITS})").isEmpty():
        return None
    found = stage(large("depth"), "crowded-nodes")
    return None if found.isEmpty() else found


def _split_pairs(rows: DataFrame, budget: int) -> DataFrame:
    """(kind, depth, used, node, side, turned) of crowded nodes, split until tasks can take them.

    ``node`` names a pair of trie nodes; side 0 is a node paired with itself, 1 and 2 are the two
    of a pair. Every node pair has at most ``NODE_ROWS`` rows.
    """
    rows = rows.select(
        "kind",
        "depth",
        "turned",
        F.lit(0).alias("side"),
        F.lit(0).alias("used"),
        F.xxhash64("kind", _top("depth")).alias("node"),
    )
    key, ready = ["kind", "depth", "used", "node"], None
    while True:
        sizes = rows.groupBy(*key).agg(
            F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high")
        )
        # A node alone, or one without its partner, links nothing.
        sizes = sizes.where("n > 1 AND (low = 0 OR low < high)").select(*key, "n")
        counted = stage(rows.join(sizes, key), "trie-counted")
        fit = counted.where(F.col("n") <= NODE_ROWS).drop("n")
        ready = fit if ready is None else ready.unionByName(fit)
        large = counted.where((F.col("n") > NODE_ROWS) & (F.col("depth") < BITS))
        if large.isEmpty():
            return ready
        rows = _split(large.drop("n"), budget)


def _split(large: DataFrame, budget: int) -> DataFrame:
    """The child pairs, ``SPLIT_BITS`` further down, of pairs with too many rows."""
    bits = F.least(F.lit(SPLIT_BITS), F.lit(BITS) - F.col("depth"))
    deeper = large.withColumn("bits", bits).withColumn(
        "child",
        F.expr(
            f"shiftrightunsigned(turned, {BITS} - depth - bits) & (shiftleft(1L, bits) - 1)"
        ),
    )
    flips = [v for v in range(1 << SPLIT_BITS) if bin(v).count("1") <= budget]
    other = F.explode(F.array(*[F.lit(v).cast("long") for v in flips]))
    pairs = deeper.withColumn("flip", other).where(
        F.expr("flip < shiftleft(1L, bits)")
        & (F.col("used") + F.bit_count("flip") <= budget)
    )
    partner = F.col("child").bitwiseXOR(F.col("flip"))
    # The left node of a pair comes first; a node with itself has one side.
    left = F.when(F.col("side") == 2, partner).when(
        F.col("side") == 1, F.col("child")
    ).otherwise(F.least("child", partner))
    right = F.when(F.col("side") == 2, F.col("child")).when(
        F.col("side") == 1, partner
    ).otherwise(F.greatest("child", partner))
    side = F.when(F.col("side") > 0, F.col("side")).when(F.col("flip") == 0, 0).otherwise(
        F.when(F.col("child") < partner, 1).otherwise(2)
    )
    return pairs.select(
        "kind",
        (F.col("depth") + F.col("bits")).alias("depth"),
        "turned",
        side.cast("int").alias("side"),
        (F.col("used") + F.bit_count("flip")).cast("int").alias("used"),
        F.xxhash64("node", left, right).alias("node"),
    )


def _links(prints: DataFrame, budget: int) -> DataFrame:
    """Edges (table, a, b) that connect the fingerprints linked within a node pair."""
    rows = _tries(prints, budget)
    crowded = _crowded(rows)
    if crowded is None:
        return _joined_nodes(rows, budget)
    marked = rows.withColumn("top", _top("depth"))
    calm = marked.join(crowded, ["kind", "top"], "left_anti").drop("top")
    hot = marked.join(crowded, ["kind", "top"], "left_semi").drop("top")
    return _joined_nodes(calm, budget).unionByName(
        _joined_pairs(_split_pairs(hot, budget), budget)
    )


def _streamed(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of about ``STREAM_ROWS`` rows that don't part the rows of a ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < STREAM_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows.column(key).to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        if len(other):
            end = int(other[-1]) + 1
            yield rows.slice(0, end)
            held = rows.slice(end).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _edges(kind: int, keys: np.ndarray, front: np.ndarray, depth: int, budget: int):
    """Each key that links, with its root; as a batch of (table, a, b), or nothing."""
    blocks = _blocks(budget)
    root = _roots(len(keys), linked_places(keys, front, depth, budget))
    more = np.flatnonzero(root != np.arange(len(root)))
    if len(more):
        table, trie = divmod(kind, len(blocks))
        first = blocks[trie][0]
        plain = _turned(keys, BITS - first if first else 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(more), table), pa.int32()),
                pa.array(plain[more].view(np.int64)),
                pa.array(plain[root[more]].view(np.int64)),
            ],
            ["table", "a", "b"],
        )


_EDGES = "table int, a long, b long"
#: Orders signed numbers as the unsigned ones with the same bits.
_UNSIGNED = -(1 << 63)


def _joined_nodes(rows: DataFrame, budget: int) -> DataFrame:
    """Edges within the top nodes of the tries; rows are dealt by node."""
    order = F.col("turned").bitwiseXOR(F.lit(_UNSIGNED))
    top = F.xxhash64("kind", _top("depth"))
    dealt = rows.select("kind", "depth", "turned", top.alias("node"))
    dealt = dealt.repartition("node").sortWithinPartitions("node", order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _streamed(batches, "node"):
            kinds = rows.column("kind").to_numpy()
            turned = rows.column("turned").to_numpy().view(np.uint64)
            depths = rows.column("depth").to_numpy()
            for kind in np.unique(kinds).tolist():
                mine = kinds == kind
                keys, depth = np.unique(turned[mine]), int(depths[mine][0])
                tops = keys >> np.uint64(BITS - depth)
                first = np.append(0, np.flatnonzero(tops[1:] != tops[:-1]) + 1)
                last = np.append(first[1:], len(keys))
                several = last - first > 1
                a, b = first[several], last[several]
                front = np.stack([a, b, a, b, np.zeros_like(a)], 1)
                yield from _edges(kind, keys, front, depth, budget)

    return in_arrow(dealt, run, _EDGES)


def _joined_pairs(pairs: DataFrame, budget: int) -> DataFrame:
    """Edges within the node pairs of split nodes; rows are dealt by node pair."""
    order = F.col("turned").bitwiseXOR(F.lit(_UNSIGNED))
    columns = ["kind", "depth", "used", "node", "side", "turned"]
    dealt = pairs.select(*columns, F.xxhash64("kind", "depth", "used", "node").alias("slice"))
    dealt = dealt.repartition("slice").sortWithinPartitions("slice", "side", order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _streamed(batches, "slice"):
            slices = rows.column("slice").to_numpy()
            first = np.append(0, np.flatnonzero(slices[1:] != slices[:-1]) + 1)
            last = np.append(first[1:], len(slices))
            turned = rows.column("turned").to_numpy().view(np.uint64)
            side = rows.column("side").to_numpy()
            about = [rows.column(c).to_numpy()[first] for c in ("kind", "depth", "used")]
            groups, of = np.unique(np.stack(about, 1), axis=0, return_inverse=True)
            for i, (kind, depth, used) in enumerate(groups.tolist()):
                # Node pairs of one kind are joined together, over their sorted distinct keys.
                mine = np.flatnonzero(of.ravel() == i)
                spans = list(zip(first[mine].tolist(), last[mine].tolist()))
                keys = np.unique(np.concatenate([turned[a:b] for a, b in spans]))
                front = []
                for a, b in spans:  # sorted by side, then by key
                    cut = a + int(np.searchsorted(side[a:b], 2)) if side[a] else a
                    left, right = (turned[a:cut], turned[cut:b]) if side[a] else (turned[a:b],) * 2
                    ends = [left[0], left[-1], right[0], right[-1]]
                    w, x, y, z = np.searchsorted(keys, ends).tolist()
                    front.append((w, x + 1, y, z + 1, used))
                yield from _edges(kind, keys, np.array(front, dtype=np.int64), depth, budget)

    return in_arrow(dealt, run, _EDGES)


# -- components --------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node of ``edges`` (a, b).

    Alternates two star contractions until no edge changes. Large star: a node's larger
    neighbours move to its smallest neighbour. Small star: a node and its smaller neighbours move
    to the smallest of them. Each round is staged.
    """
    both = F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
    )

    def stars(found: DataFrame, larger: bool) -> DataFrame:
        if larger:
            sides = found.select(F.inline(both))
        else:
            sides = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = sides.join(least, "a")
        if larger:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            own = F.array(
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            )
            moved = joined.select(F.inline(own))
        return moved.where("a <> b").distinct()

    def shape(found: DataFrame):
        return found.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).cast("string")
        ).first()

    current = stage(edges.where("a <> b").distinct(), "component-edges")
    before = shape(current)
    while before[0]:
        current = stage(stars(stars(current, True), False), "component-edges")
        after = shape(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, carried: list[str], shingle: int, budget: int, tables: int = 1
) -> DataFrame:
    """``carried`` columns (doc_id among them), ``prints``, ``root`` and ``component_id`` of each row.

    ``component_id`` is the smallest id that a document reaches over links; with several tables
    two documents link if any of their fingerprints do.
    """
    known = stage(fingerprints(docs, carried, shingle, tables), "fingerprints")
    classes = stage(
        known.groupBy("prints").agg(F.min("doc_id").alias("least")).withColumn(
            "class", F.xxhash64("prints")
        ),
        "print-classes",
    )
    prints = classes.select(F.posexplode("prints").alias("table", "print")).distinct()
    links = stage(_links(prints, budget), "print-links")
    if tables == 1:
        rooted = components(links)
        named = classes.withColumn("node", F.element_at("prints", 1)).join(rooted, "node", "left")
        named = named.select("prints", "least", F.coalesce("root", "node").alias("root"))
    else:
        # Classes meet at a fingerprint that several have, or at one that links to theirs.
        has = classes.select("class", F.posexplode("prints").alias("table", "print"))
        owner = has.groupBy("table", "print").agg(
            F.min("class").alias("owner"), F.count("*").alias("n")
        )
        ends = F.array(F.col("a"), F.col("b"))
        linked = links.select("table", F.explode(ends).alias("print")).distinct()
        owner = owner.join(linked.withColumn("linked", F.lit(True)), ["table", "print"], "left")
        owner = stage(owner.where("n > 1 OR linked").drop("n", "linked"), "print-owners")
        at_print = has.join(owner, ["table", "print"]).select(
            F.col("class").alias("a"), F.col("owner").alias("b")
        )
        from_a = owner.select("table", F.col("print").alias("a"), F.col("owner").alias("from"))
        from_b = owner.select("table", F.col("print").alias("b"), F.col("owner").alias("to"))
        over_link = (
            links.join(from_a, ["table", "a"])
            .join(from_b, ["table", "b"])
            .select(F.col("from").alias("a"), F.col("to").alias("b"))
        )
        rooted = components(at_print.unionByName(over_link))
        named = classes.join(rooted, classes["class"] == rooted["node"], "left")
        named = named.select("prints", "least", F.coalesce("root", "class").alias("root"))
    named = stage(named, "print-roots")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.join(smallest, "root").select("prints", "root", "component_id")
    return known.join(by_class, "prints")


def hex_fingerprint(print_column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(print_column), 16, "0"))
