"""Hard negatives by bounds along a spanning tree of anchors.

Vectors are integers, so an inner product is exact. The anchors of a block are joined by a tree of least total distance. Of
the root every candidate's score is computed; of any other anchor c with parent p, a candidate x has

    <p, x> - |c - p| |x|  <=  <c, x>  <=  <p, x> + |c - p| |x|,

and where the parent's score is itself only bounded, its bounds take the place of <p, x>. A candidate is rescored only where its
bounds overlap what is looked for: the window of a positive, or the best scores of the anchor's own label. A rescored candidate is
exact for the anchor's children again. Bounds choose what is computed, never what is returned.

Anchors and vectors are cut into blocks and each pair of blocks is one group of fixed size; positives are found in one pass over
the pairs, negatives in a second, and every block gives its few best of each anchor.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, read_table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
BLOCK_ANCHORS, BLOCK_VECTORS = 512, 8192
#: Integers up to which double precision is exact, and to which scores are kept in a long.
EXACT, LONG = 1 << 53, 1 << 62


def spanning_tree(points: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, distance) of a tree of least total distance, parents first; the root, nearest to the mean, has parent -1."""
    gap = lambda i: np.sqrt(((points - points[i]) ** 2).sum(axis=1))
    root = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    out, best, parent = [(root, -1, 0.0)], gap(root), np.full(len(points), root)
    open_ = np.ones(len(points), dtype=bool)
    open_[root] = False
    for _ in range(len(points) - 1):
        i = int(np.argmin(np.where(open_, best, np.inf)))
        out.append((i, int(parent[i]), float(best[i])))
        open_[i] = False
        own = gap(i)
        nearer = open_ & (own < best)
        best[nearer], parent[nearer] = own[nearer], i
    return out


class Scores:
    """A block of candidates, scored anchor by anchor down the tree. `rescored` counts the inner products below the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchors: np.ndarray):
        self.ids, self.labels, self.rescored = ids, labels, 0
        most = lambda x: int(np.abs(x).max()) if x.size else 0
        self.exact = vectors.shape[1] * most(vectors) * most(anchors) < EXACT
        kind = np.float64 if self.exact else np.int64
        self.vectors, self.anchors = vectors.astype(kind), anchors.astype(kind)
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))

    def walk(self, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores) of each anchor: the rows that wanted(anchor, low, high) marks, and their scores."""
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        points = self.anchors.astype(np.float64)
        tree = spanning_tree(points)
        children = [0] * len(tree)
        for _, parent, _ in tree[1:]:
            children[parent] += 1
        for i, parent, distance in tree:
            if parent < 0 or not self.exact:
                scores = self.vectors @ self.anchors[i]
                low = high = scores.astype(np.float64)
                rows = np.flatnonzero(wanted(i, low, high))
                scores = scores[rows]
            else:
                slack = self.norms * (distance * (1 + 1e-9)) + 1
                low, high = bounds[parent][0] - slack, bounds[parent][1] + slack
                rows = np.flatnonzero(wanted(i, low, high))
                scores = self.vectors[rows] @ self.anchors[i] if len(rows) < len(low) // 2 else (self.vectors @ self.anchors[i])[rows]
                low[rows] = high[rows] = scores
                self.rescored += len(rows)
            if parent >= 0:
                children[parent] -= 1
                if not children[parent]:
                    bounds.pop(parent, None)
            if children[i] and self.exact:
                bounds[i] = low, high
            yield i, rows, scores.astype(np.int64)

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in `rows` of the k highest scores, ties to smaller ids."""
        if len(rows) > k:  # all that tie with the k-th stay until ids decide
            keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        else:
            keep = np.arange(len(rows))
        return keep[np.lexsort((self.ids[rows[keep]], -scores[keep]))][:k]

    def positives(self, ids: np.ndarray, labels: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores) of the k highest scores of the anchor's label, its own id apart."""
        def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            own = (self.labels == labels[i]) & (self.ids != ids[i])
            least = low[own]
            return own & (high >= np.partition(least, len(least) - k)[len(least) - k]) if len(least) > k else own

        for i, rows, scores in self.walk(wanted):
            best = self.first(rows, scores, k)
            yield i, rows[best], scores[best]

    def negatives(self, labels: np.ndarray, windows: list[list[tuple[int, int]]], k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor, window, rows, scores) of the k highest scores of other labels in each of the anchor's windows, ends included."""
        def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            other, out = self.labels != labels[i], np.zeros(len(low), dtype=bool)
            for least, most in windows[i]:
                if least > most:
                    continue
                sure = low[other & (low >= least) & (high <= most)]
                if len(sure) >= k:  # that many lie inside for certain: what is below all of them is not looked for
                    least = np.partition(sure, len(sure) - k)[len(sure) - k]
                out |= (high >= least) & (low <= most)
            return out & other

        for i, rows, scores in self.walk(wanted):
            for w, (least, most) in enumerate(windows[i]):
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                best = inside[self.first(rows[inside], scores[inside], k)]
                if len(best):
                    yield i, w, rows[best], scores[best]


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest score s with 50 positive <= 100 s <= 95 positive."""
    return -(-positive // 2), 19 * positive // 20


def _matrix(table: pa.Table, n: int) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, n)


def _block(anchors: pa.Table, vectors: pa.Table) -> Scores:
    n = vectors.column("n")[0].as_py()
    return Scores(vectors.column("id").to_numpy(), vectors.column("label").to_numpy(), _matrix(vectors, n), _matrix(anchors, n))


def _find_positives(k: int):
    def run(anchors: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if anchors.num_rows and vectors.num_rows:
            ids, keys = anchors.column("id").to_numpy(), anchors.column("key").to_pylist()
            block = _block(anchors, vectors)
            for i, rows, scores in block.positives(ids, anchors.column("label").to_numpy(), k):
                for column, values in zip(out, ([ids[i]] * len(rows), [keys[i]] * len(rows), block.ids[rows], scores)):
                    column.extend(values)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["anchor_id", "key", "positive_id", "positive_score"])

    return run


def _find_negatives(k: int):
    def run(anchors: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if anchors.num_rows and vectors.num_rows:
            ids, keys = anchors.column("id").to_numpy(), anchors.column("key").to_pylist()
            windows = [[window(s) for s in own] for own in anchors.column("scores").to_pylist()]
            block = _block(anchors, vectors)
            for i, w, rows, scores in block.negatives(anchors.column("label").to_numpy(), windows, k):
                for column, values in zip(out, ([ids[i]] * len(rows), [keys[i]] * len(rows), [w] * len(rows), block.ids[rows], scores)):
                    column.extend(values)
        return pa.table([pa.array(x, pa.int32() if i == 2 else pa.int64()) for i, x in enumerate(out)], names=["anchor_id", "key", "place", "negative_id", "negative_score"])

    return run


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """id, label, v (integers), n (dimensions) of rows that take part, repeats of a row once.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. A label is moved on by one, modulo
    10, where 7 divides the id. Components are floor(scale * x); those beyond what keeps every inner product in a long count as that
    bound, which for 64 dimensions is 2^28.
    """
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    most = F.pow(F.lit(2.0), F.floor((62 - F.ceil(F.log2(F.greatest(F.size(x), F.lit(1)).cast("double")))) / 2)).cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fine)
    scaled = F.transform(x, lambda y: F.greatest(F.least(F.floor(y * scale), most), -most))
    return rows.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), scaled.alias("v"), F.size(x).alias("n")).distinct()


def _paired(anchors: DataFrame, vectors: DataFrame):
    """Both tables' groups, one for each pair of blocks of one number of dimensions. Only the counts by dimensions reach the driver."""
    sizes = [{r.n: max(1, math.ceil(r["count"] / size)) for r in df.groupBy("n").count().collect()} for df, size in ((anchors, BLOCK_ANCHORS), (vectors, BLOCK_VECTORS))]
    shared = sorted(set(sizes[0]) & set(sizes[1])) or [-1]
    blocks = lambda side: F.element_at(F.create_map(*[x for n in shared for x in (F.lit(n), F.lit(sizes[side].get(n, 1)))]), F.col("n")).cast("long")

    def dealt(df: DataFrame, own: int, names: tuple[str, str]) -> DataFrame:
        return df.where(F.col("n").isin(shared)).select(
            *[F.col(c).alias(c) for c in df.columns], F.pmod(F.xxhash64(F.lit(own), "id", "label", "v"), blocks(own)).alias(names[0]), F.explode(F.sequence(F.lit(0).cast("long"), blocks(1 - own) - 1)).alias(names[1])
        )

    return dealt(anchors, 0, ("ab", "vb")).groupBy("n", "ab", "vb").cogroup(dealt(vectors, 1, ("vb", "ab")).groupBy("n", "ab", "vb"))


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = 50) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors of `usable` rows: ids divisible by `every`.

    An anchor's positives are the `positives` rows of its label with the highest scores, of each positive the `negatives` rows of other
    labels with the highest scores in its window; ties go to smaller ids. Rows with the anchor's id are its own and take no part; only
    vectors with as many dimensions are compared. Different rows under one id are different rows, also as anchors. An anchor without
    positives, a positive without a negative, and an empty table give no rows.
    """
    vectors = cut_lineage(vectors)
    anchors = vectors.where(F.col("id") % every == 0).withColumn("key", F.xxhash64("label", "v"))
    found = _paired(anchors, vectors).applyInArrow(_find_positives(positives), "anchor_id bigint, key bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id", "key").orderBy(F.col("positive_score").desc(), "positive_id")
    best = cut_lineage(found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives))
    scores = best.groupBy(F.col("anchor_id").alias("id"), "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x.positive_score).alias("scores"))
    near = _paired(anchors.join(scores, ["id", "key"]), vectors).applyInArrow(_find_negatives(negatives), "anchor_id bigint, key bigint, place int, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "key", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.join(ranked, ["anchor_id", "key", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the hard negatives of every row of embeddings whose id is divisible by 50, as `mine` defines them; other columns are not read."""
    return mine(usable(read_table(spark, sf_dir, "embeddings")))


SQL = """
WITH u AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM u a JOIN u b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
"""
