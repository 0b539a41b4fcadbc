"""Vector codes by product quantisation, the nearest entry found by slicing sorted coordinates and intersecting bit masks.

A codebook has at most 64 entries. In each dimension its coordinates are sorted, and for every place the mask of the entries up to there is
kept (prefix masks). For a part to be coded, the entries whose coordinates are nearest in four of the dimensions give an initial radius: the least
of their distances. An entry as near or nearer lies in every dimension within that radius, so in each dimension the entries from the lower to the
upper end of a slice are one mask, prefix[upper] without prefix[lower], and the AND over all dimensions leaves the candidates,
the nearest and all that tie with it among them. Only candidates get their exact distance.

Everything is in integers. A round's sums are added up by Spark; the driver holds codebooks, whose size does not depend on the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, read_table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components after scaling count as at most this, so that a distance always fits into a long.
MOST = 1 << 24
LONG = (1 << 63) - 1


class Slices:
    """One part's codebook, ready to be searched: sorted coordinates and prefix masks of each dimension."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a codebook of more than 64 entries does not fit a mask of 64 bits")
        self.entries = entries.astype(np.int64)
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, axis=0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), dtype=np.uint64)
        self.prefix[1:] = np.bitwise_or.accumulate(bits, axis=0)
        self.order = order

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """For each part the mask of all entries that may be as near as its initial radius."""
        radius = np.full(len(parts), LONG)
        for d in sorted({0, parts.shape[1] // 3, 2 * parts.shape[1] // 3, parts.shape[1] - 1}):
            at = np.minimum(np.searchsorted(self.sorted[:, d], parts[:, d]), len(self.entries) - 1)
            before = np.maximum(at - 1, 0)
            nearer = np.abs(self.sorted[before, d] - parts[:, d]) < np.abs(self.sorted[at, d] - parts[:, d])
            first = self.order[np.where(nearer, before, at), d]
            radius = np.minimum(radius, ((parts - self.entries[first]) ** 2).sum(axis=1))
        radius = np.floor(np.sqrt(radius.astype(np.float64))).astype(np.int64) + 1
        mask = np.full(len(parts), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            mask &= self.prefix[high, d] & ~self.prefix[low, d]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part, ties to the lower entry."""
        parts = parts.astype(np.int64)
        mask = self.candidates(parts)
        best, entry = np.full(len(parts), LONG), np.zeros(len(parts), dtype=np.int64)
        for e in range(len(self.entries)):
            rows = np.flatnonzero(mask & (np.uint64(1) << np.uint64(e)))
            if len(rows):
                distance = ((parts[rows] - self.entries[e]) ** 2).sum(axis=1)
                nearer = distance < best[rows]
                best[rows[nearer]], entry[rows[nearer]] = distance[nearer], e
        return entry, best


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and v (integers floor(4096 x), within MOST) of rows whose vector is not null and holds finite numbers only."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    scaled = F.transform(x, lambda y: F.greatest(F.least(F.floor(y * SCALE), F.lit(MOST)), F.lit(-MOST)).cast("int"))
    return vectors.where(x.isNotNull() & fine).select("vec_id", "label", scaled.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of `width`, zeros after shorter ones."""
    sizes = np.diff(column.offsets.to_numpy()) if isinstance(column, pa.ListArray) else np.array([len(x) for x in column])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    for row, size, end in zip(out, sizes, np.cumsum(sizes)):
        row[:size] = flat[end - size : end]
    return out


def _coded(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances) of every vector's parts; `books` is parts x entries x dimensions of a part."""
    size = books.shape[2]
    found = [Slices(book).nearest(v[:, p * size : (p + 1) * size]) for p, book in enumerate(books)]
    return np.stack([e for e, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: every entry the floored mean of its parts, unused ones as they were.

    Each task adds up its own parts, Spark adds the tasks' sums; as many rows as there are entries reach the driver.
    """
    sent = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, size), dtype=np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), parts * size)
            entry, _ = _coded(v, own)
            for p in range(parts):
                count[p] += np.bincount(entry[:, p], minlength=entries)
                np.add.at(total[p], entry[:, p], v[:, p * size : (p + 1) * size])
        used = np.argwhere(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(count[count > 0], pa.int64()), pa.array(total[count > 0].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"]
        )

    tasks = rows.select("v").mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    each = tasks.select("part", "entry", "n", *[F.col("total")[i].alias(f"t{i}") for i in range(size)])
    out = books.copy()
    for r in each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"t{i}").cast("decimal(38,0)")).alias(f"t{i}") for i in range(size)]).collect():
        out[r.part, r.entry] = [int(r[f"t{i}"]) // r.n for i in range(size)]
    return out


def first_books(rows: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors of the smallest ids, nulls last, of one id by the vectors' components."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    whole = np.zeros((len(first), width), dtype=np.int64)
    for row, r in zip(whole, first):
        row[: len(r.v)] = r.v
    return whole.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def fitted(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks of `usable` rows, parts x entries x dimensions, after `rounds` rounds over all of them.

    Vectors shorter than the longest are filled up with zeros, to a multiple of the number of parts. Fewer rows than entries give as many
    entries as there are rows; no row gives codebooks without entries.
    """
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return np.zeros((PARTS, 0, 1), dtype=np.int64)
    books = first_books(rows, PARTS * max(1, math.ceil(longest / PARTS)))
    for _ in range(rounds):
        books = improved(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (hex digits by part) and error of every row."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    kind = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            entry, distance = _coded(_matrix(batch.column(2), own.shape[0] * own.shape[2]), own)
            code = [row.tobytes().hex() for row in entry.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code), pa.array(distance.sum(axis=1), pa.int64())], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "v").mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error bigint")


def decode(codes: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """`codes` with v, the vector (integers) that each code stands for."""
    parts, entries, _ = books.shape
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in books[p, e]]) for e in range(entries)]) for p in range(parts)])
    place = lambda p: F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("v", F.concat(*[F.get(F.get(table, F.lit(p)), place(p)) for p in range(parts)]))


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error and label_error of every usable row, and the codebooks.

    Repeated rows stay, null ids too; an empty table gives no rows. label_error adds up all rows of one label, nulls together; a sum beyond a
    long counts as the largest. Labels are summed before they are joined back, and codes are written first, so that a label with a third of
    all rows is neither one task's work nor counted twice.
    """
    rows = cut_lineage(usable(vectors))
    books = fitted(rows, rounds)
    if not books.shape[1]:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), books
    coded = cut_lineage(encode(rows, books))
    label = F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit(0).cast(dict(coded.dtypes)["label"])).alias("label"))
    sums = coded.groupBy(label.alias("__label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.withColumn("__label", label).join(sums, "__label").select("vec_id", "label", "code", "error", "label_error"), books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the codes of every usable row of embeddings, as `compress` defines them; other columns are not read."""
    coded, books = compress(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same in SQL: one step for each assignment and each new codebook."""
    steps = [
        "u AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"q AS MATERIALIZED (SELECT r, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM u, range({PARTS}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS y FROM q WHERE r <= {ENTRIES})",
    ]
    for i in range(ROUNDS + 1):
        square = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT r, p, e, CAST({square} AS BIGINT) AS d FROM q JOIN b{i} USING (p)) GROUP BY r, p)")
        if i < ROUNDS:
            mean = "SELECT p, e, list(m ORDER BY k) AS y FROM (SELECT p, e, k, CAST(floor(sum(c) / count(*)) AS BIGINT) AS m FROM (SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS k FROM q JOIN a{0} USING (r, p)) GROUP BY p, e, k) GROUP BY p, e".format(i)
            steps.append(f"b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.y, b{i}.y) AS y FROM b{i} LEFT JOIN ({mean}) n USING (p, e))")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})")
    steps.append(f"c AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM u JOIN c USING (r), h"


SQL = _sql()
