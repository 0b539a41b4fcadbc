"""Approximate nearest neighbours by cosine with collision-counting, query-aware hashing.

Vectors are scaled to length one, so the nearest by Euclidean distance have the largest cosine. Each of PROJECTIONS random
directions is one hash function: an index block keeps the projections of its vectors in one sorted array for each.
A query looks, in each array, at the window of half width RADIUS_WIDTH * R around its own projection; a vector seen in at
least THRESHOLD of the windows is verified by its exact cosine. Virtual rehashing widens R step by step, and only
what the wider windows add is counted. A query ends once its k-th best verified distance is at most R: a vector at
distance R or nearer is in each window with probability `chance`, and the threshold lies far enough under its mean.

Queries and vectors are cut into blocks and every pair of blocks is one group, so a group's size is fixed and no table is
sent whole to any task. Every vector is indexed and there is no cap on candidates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.llm.common import read_table

PROJECTIONS = 96
RADIUS_WIDTH = 1.0
#: Standard deviations by which the collision threshold lies under the mean at distance R.
MARGIN = 2.0
FIRST_RADIUS, GROWTH, LAST_RADIUS = 0.2, 1.3, 2.0
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 512
NEIGHBOURS = 5
SEED = 20240607


def threshold(projections: int = PROJECTIONS, width: float = RADIUS_WIDTH, margin: float = MARGIN) -> int:
    chance = math.erf(width / math.sqrt(2))
    return math.ceil(projections * chance - margin * math.sqrt(projections * chance * (1 - chance)))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by their largest entry, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Block:
    """The sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, unit(vectors)
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        placed = self.vectors @ self.directions
        self.order = np.argsort(placed, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(placed.T, self.order, axis=1)

    def windows(self, queries: np.ndarray) -> tuple[list[float], np.ndarray]:
        """The radii, and where each query's windows begin and end: (queries, radii, 2, projections).

        At the last radius windows hold everything, as no two vectors of length one are further apart."""
        radii = [FIRST_RADIUS]
        while radii[-1] < LAST_RADIUS:
            radii.append(radii[-1] * GROWTH)
        half = RADIUS_WIDTH * np.array(radii)
        centres = queries @ self.directions
        out = np.empty((len(queries), len(radii), 2, PROJECTIONS), dtype=np.int32)
        for i, row in enumerate(self.sorted):
            out[:, :, 0, i] = np.searchsorted(row, centres[:, i, None] - half)
            out[:, :, 1, i] = np.searchsorted(row, centres[:, i, None] + half, "right")
        out[:, -1, 0], out[:, -1, 1] = 0, len(self.ids)
        return radii, out

    def search(self, id: int, query: np.ndarray, radii: list[float], windows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k nearest found, the query's own row apart, ties to smaller ids."""
        n, need = len(self.ids), threshold()
        seen = np.zeros(n, dtype=np.int64)
        cosine = np.full(n, -2.0)
        own = self.ids == id
        low = high = windows[0, 0]
        for radius, (to_low, to_high) in zip(radii, windows):
            added = [self.order[i, a:b] for i, (a, b) in enumerate(zip(to_low.tolist(), low.tolist())) if b > a]
            added += [self.order[i, a:b] for i, (a, b) in enumerate(zip(high.tolist(), to_high.tolist())) if b > a]
            if added:
                seen += np.bincount(np.concatenate(added), minlength=n)
            low, high = to_low, to_high
            new = np.flatnonzero((seen >= need) & (cosine == -2.0) & ~own)
            if len(new):
                cosine[new] = np.clip((self.vectors[new] * query).sum(axis=1), -1.0, 1.0)
            verified = cosine[cosine > -2.0]
            if len(verified) >= k and math.sqrt(max(0.0, 2 - 2 * np.partition(verified, len(verified) - k)[len(verified) - k])) <= radius:
                break
        found = np.flatnonzero(cosine > -2.0)
        if len(found) > k:  # all that tie with the k-th stay until ids decide
            found = found[cosine[found] >= np.partition(cosine[found], len(found) - k)[len(found) - k]]
        best = found[np.lexsort((self.ids[found], -cosine[found]))][:k]
        return self.ids[best], cosine[best]


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            rows = lambda t: np.stack([np.asarray(x, dtype=np.float64) for x in t.column("v").to_numpy()])
            ids = right.column("id").to_numpy()
            block, queries = Block(ids, rows(right)), unit(rows(left))
            radii, windows = block.windows(queries)
            for id, query, own in zip(left.column("id").to_pylist(), queries, windows):
                found, score = block.search(id, query, radii, own, k)
                out["query_id"] += [id] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += score.tolist()
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return run


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (doubles) and n (dimensions) of rows that take part: not null, not zero, all components finite numbers."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id).isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0)).select(F.col(id).cast("long").alias("id"), v.alias("v"), F.size(v).alias("n"))


def nearest(queries: DataFrame, vectors: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest vectors of each query, both tables as `usable` gives them: query_id, rank, vec_id, score.

    Only vectors with the query's number of dimensions are compared. Rows with the query's id are its own and are left
    out; repeats of a row (one id and vector) are one candidate. A query with fewer candidates gets them all; one without any
    gets no row, as does an empty table.
    """
    queries, vectors = queries.distinct(), vectors.distinct()
    counted = {"q": queries.groupBy("n").count().collect(), "v": vectors.groupBy("n").count().collect()}
    blocks = {side: {r.n: max(1, math.ceil(r["count"] / size)) for r in counted[side]} for side, size in (("q", BLOCK_QUERIES), ("v", BLOCK_VECTORS))}
    shared = sorted(set(blocks["q"]) & set(blocks["v"]))
    table = lambda side: F.element_at(F.create_map(*[x for n in shared for x in (F.lit(n), F.lit(blocks[side][n]))]), F.col("n"))
    if not shared:
        return queries.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    spread = lambda df, own, other, seed, names: df.where(F.col("n").isin(shared)).select(
        "id", "v", "n", F.pmod(F.xxhash64(F.lit(seed), "id"), table(own)).alias(names[0]), F.explode(F.sequence(F.lit(0).cast("long"), (table(other) - 1).cast("long"))).alias(names[1])
    )
    left, right = spread(queries, "q", "v", 1, ("qb", "vb")), spread(vectors, "v", "q", 2, ("vb", "qb"))
    pairs = left.groupBy("n", "qb", "vb").cogroup(right.select("id", "v", "n", "qb", "vb").groupBy("n", "qb", "vb"))
    found = pairs.applyInArrow(_search(k), "query_id bigint, vec_id bigint, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the nearest of every vector whose id is divisible by 50, as `nearest` defines them; other columns are not read."""
    vectors = usable(read_table(spark, sf_dir, "embeddings"))
    return nearest(vectors.where("id % 50 = 0"), vectors)
