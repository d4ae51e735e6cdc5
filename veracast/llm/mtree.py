"""Exact top-k inner products by best-first search of an M-tree.

The tree has three levels. Pivots from a bounded sample deal the vectors out; a pivot's vectors
make pages of about ``PAGE_ROWS`` (more pages where many vectors lie at one pivot, however alike
they are). A page holds leaf nodes around own members. Every node stores its covering radius and
its distance to its parent, every vector the distance to its leaf's centre.

For a query q, a node with centre c and radius r holds no score above q.c + |q| r, and by the
triangle inequality q.c is at most (|q|^2 + |c|^2 - (d(q, parent) - d(c, parent))^2) / 2. The latter
needs no distance to c: only nodes and vectors that pass it are computed at all. Nodes are taken
best bound first, until no bound reaches the k-th best score. Each query first searches the page it
lies in; that score then rules out pages before anything is sent to them.

Queries and pages meet in blocks of bounded size, keyed by page. Scores are exact integers; bounds
are rounded upwards. A tie goes to the smaller id.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part;
a shorter vector counts as continued by zeros. Rows with a query's id are no candidates of it, and
equal rows count once. No vectors, or one, give no rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow
from veracast.shipping import ship
from veracast.sources.scratch import stage

PAGE_ROWS, LEAF_ROWS = 4096, 32
SAMPLE_ROWS, MOST_PIVOTS = 4096, 256
#: Queries that one task searches a page for, and pages looked at for pruning at once.
QUERY_ROWS, DIRECTORY_ROWS = 1024, 4096
#: Whole numbers below this add up exactly as doubles.
_EXACT = 1 << 53


def integer_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component x of every usable vector."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    rows = embeddings.where(usable).where(~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")).distinct()


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x.astype(float) - centre) ** 2).sum(1))


def _spread(x: np.ndarray, k: int) -> list[int]:
    """``k`` rows far from each other, each the farthest from those before it."""
    chosen, near = [0], _distances(x, x[0])
    while len(chosen) < min(k, len(x)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(x, x[chosen[-1]]))
    return chosen


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    best = np.full(len(x), np.inf)
    at = np.zeros(len(x), dtype=np.int64)
    for i, centre in enumerate(centres):
        d = _distances(x, centre)
        closer = d < best
        best[closer], at[closer] = d[closer], i
    return at


class Page:
    """Leaf nodes of one page, and best-first search in them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, centre: np.ndarray):
        centres = x[_spread(x, -(-len(x) // LEAF_ROWS))]
        leaf = _nearest(x, centres)
        order = np.lexsort((ids, leaf))
        self.ids, self.x, leaf = ids[order], x[order], leaf[order]
        there, self.first = np.unique(leaf, return_index=True)
        self.last = np.append(self.first[1:], len(leaf))
        self.centre, self.leaf_centre = centre.astype(float), centres[there].astype(float)
        self.to_leaf = _distances(self.x, centres[leaf])
        self.leaf_radius = np.maximum.reduceat(self.to_leaf, self.first)
        self.leaf_parent = _distances(self.leaf_centre, self.centre)
        self.leaf_square = (self.leaf_centre**2).sum(1)
        self.square = (self.x.astype(float) ** 2).sum(1)
        self.norm = math.sqrt(self.square.max())
        self.radius = float(_distances(self.x, self.centre).max())

    def _scores(self, rows: slice | np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.norm * math.sqrt(float((q.astype(float) ** 2).sum())) < _EXACT:
            return (self.x[rows].astype(float) @ q.astype(float)).astype(np.int64)
        return np.array([sum(map(int.__mul__, r, q.tolist())) for r in self.x[rows].tolist()])

    def search(self, own: int, q: np.ndarray, k: int, least: float) -> list[tuple[int, int]]:
        """The best (score, id) of the page with a score of ``least`` or more, ``k`` at most."""
        real = q.astype(float)
        square = float((real**2).sum())
        length = math.sqrt(square)
        slack = 1e-9 * (square + float(self.square.max())) + 1e-6
        to_page = math.sqrt(((real - self.centre) ** 2).sum())
        # By the stored distances to the parent: no distance to a leaf is computed yet.
        reach = (square + self.leaf_square - (to_page - self.leaf_parent) ** 2) / 2
        leaves = np.flatnonzero(reach + length * self.leaf_radius + slack >= least)
        dots = self.leaf_centre[leaves] @ real
        bounds = dots + length * self.leaf_radius[leaves] + slack
        found: list[tuple[int, int]] = []  # (score, -id), best first
        for i in np.argsort(-bounds, kind="stable").tolist():
            if bounds[i] < least:
                break
            at = leaves[i]
            a, b = self.first[at], self.last[at]
            to_leaf = math.sqrt(max(0.0, square + self.leaf_square[at] - 2 * dots[i]))
            most = (square + self.square[a:b] - (to_leaf - self.to_leaf[a:b]) ** 2) / 2
            rows = a + np.flatnonzero(most + slack >= least)
            scores = self._scores(rows, q)
            fresh = [
                (int(s), -int(v))
                for s, v in zip(scores.tolist(), self.ids[rows].tolist())
                if s >= least and v != own
            ]
            if fresh:
                found = sorted(set(found + fresh), reverse=True)[:k]
                if len(found) == k:
                    least = max(least, found[-1][0])
        return [(s, -v) for s, v in found]


def _pivots(vectors: DataFrame, n: int, width: int) -> np.ndarray:
    scale = 1 << 30
    share = F.pmod(F.xxhash64("vec_id"), F.lit(scale)) < F.lit(scale * SAMPLE_ROWS // n)
    sample = vectors if n <= SAMPLE_ROWS else vectors.where(share)
    rows = sorted((r["vec_id"], r["vector"]) for r in sample.collect())  # about SAMPLE_ROWS
    x = np.zeros((len(rows), width), dtype=np.int64)
    for i, (_, row) in enumerate(rows):
        x[i, : len(row)] = row
    return x[_spread(x, min(MOST_PIVOTS, -(-n // PAGE_ROWS)))]


def _dealt(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with the nearest pivot."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _nearest(_matrix(batch.column(1), width), pivots)
            columns = [*batch.columns, pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "pivot"])

    return in_arrow(vectors, run, "vec_id long, vector array<long>, pivot int")


def _pages(dealt: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(page, pivot, n, radius, tree) of every page; ``dealt`` has page and pivot."""
    width = pivots.shape[1]

    def build(rows: pa.Table) -> pa.Table:
        pivot = rows.column("pivot")[0].as_py()
        ids = rows.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        page = Page(ids[order], _matrix(rows.column("vector"), width)[order], pivots[pivot])
        return pa.table(
            {
                "page": pa.array([rows.column("page")[0].as_py()], pa.int64()),
                "pivot": pa.array([pivot], pa.int32()),
                "radius": [page.radius],
                "tree": pa.array([pickle.dumps(page, protocol=5)], pa.binary()),
            }
        )

    ship(dealt.sparkSession)
    return dealt.groupBy("page").applyInArrow(
        build, "page long, pivot int, radius double, tree binary"
    )


def _searched(asked: DataFrame, pages: DataFrame, k: int, width: int) -> DataFrame:
    """(query_id, vec_id, score) of each row (page, query_id, vector, least) of ``asked``."""
    parts = asked.groupBy("page").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("parts"))
    asked = asked.join(parts, "page").withColumn(
        "part", F.pmod(F.xxhash64("query_id"), F.col("parts"))
    )
    copies = pages.join(parts, "page").select(
        "page", "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    )

    def search(queries: pa.Table, page: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if queries.num_rows:
            tree: Page = pickle.loads(page.column("tree")[0].as_py())
            x = _matrix(queries.column("vector"), width)
            own, least = (queries.column(c).to_pylist() for c in ("query_id", "least"))
            for q, query_id, low in zip(x, own, least):
                found = tree.search(query_id, q, k, -math.inf if low is None else low)
                out += [(query_id, v, s) for s, v in found]
        columns = list(zip(*out)) or [[], [], []]
        names = ["query_id", "vec_id", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    ship(asked.sparkSession)
    left = asked.select("page", "part", "query_id", "vector", "least").groupBy("page", "part")
    return left.cogroup(copies.groupBy("page", "part")).applyInArrow(
        search, "query_id long, vec_id long, score long"
    )


def _reaching(queries: DataFrame, pages: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows of ``queries`` for each other page whose bound reaches the query's ``least``."""
    width, real = pivots.shape[1], pivots.astype(float)
    spread = pages.select("page", "pivot", "radius").where("page IS NOT NULL")
    chunks = max(1, -(-spread.count() // DIRECTORY_ROWS))
    schema = "page long, query_id long, vector array<long>, least long"
    found = None
    for i in range(chunks):  # one, up to DIRECTORY_ROWS pages
        mine = F.pmod(F.xxhash64("page"), F.lit(chunks)) == i
        known = sorted(tuple(r) for r in spread.where(mine).collect())
        page = np.array([r[0] for r in known])
        at, radius = np.array([r[1] for r in known], dtype=int), np.array([r[2] for r in known])

        def run(batches, page=page, at=at, radius=radius):
            for batch in batches:
                x = _matrix(batch.column(2), width).astype(float)
                length = np.sqrt((x * x).sum(1, keepdims=True))
                bound = (x @ real.T)[:, at] + length * radius
                bound += 1e-9 * (np.abs(bound) + length * length) + 1e-6
                least = batch.column(3).cast(pa.float64()).fill_null(-math.inf).to_numpy()
                home = batch.column(0).to_numpy()
                q, p = np.nonzero((bound >= least[:, None]) & (home[:, None] != page))
                rows = batch.take(pa.array(q))
                columns = [pa.array(page[p], pa.int64()), *rows.columns[1:]]
                yield pa.RecordBatch.from_arrays(columns, ["page", "query_id", "vector", "least"])

        part = in_arrow(queries.select("page", "query_id", "vector", "least"), run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def top_inner_products(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best among the other ids."""
    vectors = stage(vectors, "vectors")
    about = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not about["n"]:
        return vectors.select(
            F.col("vec_id").alias("query_id"),
            F.lit(1).alias("rank"),
            "vec_id",
            F.col("vec_id").alias("score"),
        )
    width = max(1, about["width"])
    pivots = _pivots(vectors, about["n"], width)
    dealt = stage(_dealt(vectors, pivots), "vectors-dealt")
    crowd = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / PAGE_ROWS).alias("pages"))
    page = F.col("pivot") + MOST_PIVOTS * F.pmod(F.xxhash64("vec_id", "vector"), F.col("pages"))
    # One row per pivot, MOST_PIVOTS at most.
    dealt = stage(dealt.join(F.broadcast(crowd), "pivot").withColumn("page", page), "vectors-paged")
    pages = stage(_pages(dealt.select("page", "pivot", "vec_id", "vector"), pivots), "mtree-pages")
    queries = dealt.where(is_query).select("page", F.col("vec_id").alias("query_id"), "vector")
    home = _searched(queries.withColumn("least", F.lit(None).cast("long")), pages, k, width)
    home = stage(home, "home-scores")
    full = home.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    asked = queries.join(full, "query_id", "left").withColumn(
        "least", F.when(F.col("n") >= k, F.col("low"))
    )
    far = _searched(stage(_reaching(asked, pages, pivots), "queries-out"), pages, k, width)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = home.unionByName(far).distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
