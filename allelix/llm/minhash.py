"""Document fingerprints by MinHash over word shingles, and near-duplicate classes by signature bands.

A shingle is WORDS consecutive words, lower-cased A to Z. Each of PERMUTATIONS universal hash functions (a x + b modulo
2^64, a odd) ranks the shingles, and the least rank of each, mixed to 16 bits, is one place of the signature. The share
of equal places estimates the Jaccard similarity of the shingle sets.

Classes: signatures are cut into bands and joined in Spark on equal bands. In a band's bucket the signatures are
compared with numpy and all likely pairs go on, so their number grows with the square of a group of near copies; a bucket
too large for a task is cut into blocks that meet pair by pair. The pairs are verified by exact Jaccard similarity in Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, read_table, shuffle_width, utf8, word_blocks
from allelix.llm.graph import connected_components

PERMUTATIONS, WORDS, BANDS = 128, 5, 32
SIMILAR = 0.8
#: Shingles that are ranked at once; sampled keys between which runs of neighbours are cut; signatures of a block.
AT_ONCE, BOUNDS, BLOCK = 2048, 20_000, 2048
_random = np.random.default_rng(20240607)
_A = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
_M = _random.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
NOTHING = np.full(PERMUTATIONS, np.iinfo(np.uint64).max)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def shingles_of(words: np.ndarray) -> np.ndarray:
    """32-bit hashes of the runs of WORDS word hashes."""
    n = len(words) - WORDS + 1
    x = sum((words[i : i + n] * _M[i] for i in range(WORDS)), np.zeros(n, dtype=np.uint64))
    return ((x ^ (x >> np.uint64(29))) * _MIX) >> np.uint64(32)


def short_shingle(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer words: all of them."""
    return np.array([xxhash.xxh64_intdigest(words.tobytes())], dtype=np.uint64) >> np.uint64(32)


def ranks(shingles: np.ndarray, least: np.ndarray = NOTHING) -> np.ndarray:
    """The least rank of each permutation over the shingles and `least`."""
    least = least.copy()
    for at in range(0, len(shingles), AT_ONCE):
        placed = np.multiply.outer(_A, shingles[at : at + AT_ONCE])
        placed += _B[:, None]
        np.minimum(least, placed.min(axis=1), out=least)
    return least


def signature(least: np.ndarray) -> np.ndarray:
    return (((least ^ (least >> np.uint64(29))) * _MIX) >> np.uint64(48)).astype(np.uint16)


def text_ranks(text: bytes) -> np.ndarray:
    """Least ranks of a whole text, in blocks of bounded size; NOTHING for a text without words."""
    least = NOTHING
    for words, first in word_blocks(text.lower(), WORDS - 1):
        if len(words) >= WORDS:
            least = ranks(shingles_of(word_hashes(words)), least)
        elif words and first:
            least = ranks(short_shingle(word_hashes(words)), least)
    return least


def text_signature(text: bytes) -> np.ndarray:
    return signature(text_ranks(text))


def hex_of(places: np.ndarray) -> str:
    return places.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited_text(text: str, other: str) -> str:
    """`text` with its last third (rounded down) of code points replaced by as many of the first of `other`."""
    k = len(text) // 3
    return text[: len(text) - k] + other[:k]


def in_runs(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, text, key, run and guest: rows in runs of neighbours by descending key, each run followed by a guest, the first row of the
    next run (of the first run after the last).

    The key is the id, then a hash of the text, so one id with many texts spreads over runs; null ids come last. Runs are cut
    at quantiles of a sample of BOUNDS keys at most, the only thing that reaches the driver beside a row for each run, so ids far
    apart do no harm; the sample decides borders alone.
    """
    plain = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sort = F.struct(F.col("doc_id").isNotNull().alias("given"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    keyed = plain.withColumn("key", sort)
    spread = F.pmod(F.xxhash64(F.lit(29), "doc_id", F.col("key.hash")), F.lit(max(1, plain.count() // BOUNDS)))
    sample = sorted((r.given, r.id if r.given else None, r.hash) for r in keyed.where(spread == 0).select("key.*").distinct().orderBy(F.xxhash64("hash")).limit(2 * BOUNDS).collect() if r.given)
    runs = min(4 * shuffle_width(docs), max(1, len(sample)))
    borders = [sample[len(sample) * i // runs] for i in range(runs - 1, 0, -1)]
    kind = keyed.schema["key"].dataType.simpleString()
    edge = lambda b: F.struct(F.lit(b[0]).alias("given"), F.lit(b[1]).alias("id"), F.lit(b[2]).alias("hash")).cast(kind)
    table = F.array(*[edge(b) for b in borders]) if borders else F.array().cast(f"array<{kind}>")
    dealt = keyed.withColumn("run", F.size(F.filter(table, lambda b: b > F.col("key"))))
    heads = dealt.groupBy("run").agg(F.max("key").alias("head"))
    first = {r.run: (r.head.given, r.head.id, r.head.hash) for r in heads.collect()}
    order = sorted(first)
    before = {run: order[i - 1] for i, run in enumerate(order)}
    own = dealt.withColumn("guest", F.lit(False))
    if not order:
        return own
    at = F.create_map(*[x for run in order for x in (F.lit(run), edge(first[run]))])
    to = F.create_map(*[x for run in order for x in (F.lit(run), F.lit(before[run]))])
    guests = dealt.where(F.col("key").eqNullSafe(F.element_at(at, F.col("run")))).dropDuplicates(["run"])
    return own.unionByName(guests.withColumns({"run": F.element_at(to, F.col("run")), "guest": F.lit(True)}))


def _begun(id, text: str) -> tuple:
    """(id, text, least ranks, words that an edit of the last third leaves alone, their hashes' end, their ranks)."""
    body, k = text.encode().lower(), len(text) // 3
    start = len(text[: len(text) - k].encode().split()) - 1  # the last word may be cut
    if start < WORDS or len(body) > 1 << 22:
        return id, text, text_ranks(body), 0, None, None
    hashes = word_hashes(body.split())
    kept = ranks(shingles_of(hashes[:start]))
    return id, text, ranks(shingles_of(hashes[start - WORDS + 1 :]), kept), start, hashes[start - WORDS + 1 : start], kept


def _compared(a: tuple, b: tuple) -> tuple:
    """The output row of a, b being the next document, both as _begun gives them. Ranks of the part that the edit
    leaves alone are not taken twice."""
    id, text, least, start, tail, kept = a
    changed = edited_text(text, b[1])
    if start:
        words = changed.encode().lower().split()
        new = ranks(shingles_of(np.concatenate([tail, word_hashes(words[start:])])), kept) if len(words) > start else kept
    else:
        new = text_ranks(changed.encode())
    own, other = signature(least), signature(new)
    return id, len(text), hashlib.sha256(changed.encode()).hexdigest(), hex_of(own), hex_of(other), likeness(own, other), likeness(own, signature(b[2]))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kind, last, out = pa.int64(), None, []
    for batch in batches:
        kind = batch.schema.field(0).type
        for id, text, run, guest in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            row = None
            if last is not None or not guest:
                row = _begun(id, text)
            if last is not None:
                out.append(_compared(last, row))
            last = None if guest else row
            if len(out) >= 500:
                yield _rows(out, names, kind)
                out = []
    if out:
        yield _rows(out, names, kind)


def _rows(out: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def compare_with_edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint, its edited text's, and how like they and the next document's are.

    A null text counts as the empty text; rows with equal ids follow each other in the order of a hash of their texts,
    null ids come last; ids may be of any type that orders. A table of one row has itself as next; an empty table gives no rows. Other columns are not read.
    """
    kind = docs.schema[id].dataType.simpleString()
    dealt = in_runs(docs, id, text).repartition(shuffle_width(docs), "run").sortWithinPartitions("run", "guest", F.col("key").desc(), "text")
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("doc_id", "text", "run", "guest").mapInArrow(_compare, schema)


def signatures(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and signature (binary) of every row; null texts as empty ones, repeats and null ids stay, no other column is read."""
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([text_signature(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())], names=["doc_id", "signature"])

    return docs.select(F.col(id).alias("doc_id"), utf8(text).alias("__text")).mapInArrow(run, f"doc_id {kind}, signature binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """key and shingles (sorted distinct 32-bit hashes) of the table (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x in batch.column(1):
                words = word_hashes(x.as_py().lower().split())
                found.append(np.unique(shingles_of(words) if len(words) >= WORDS else short_shingle(words) if len(words) else words).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["key", "shingles"])

    return docs.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"key {docs.schema['key'].dataType.simpleString()}, shingles array<bigint>")


def _likely(least: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = lambda t: (t.column("key").to_numpy(), np.stack([np.frombuffer(x.as_py(), np.uint16) for x in t.column("signature")]) if t.num_rows else np.zeros((0, PERMUTATIONS), np.uint16))
        (a, sa), (b, sb) = rows(left), rows(right)
        hits = [np.flatnonzero(((sb == sa[i]).mean(axis=1) >= least) & (b > a[i])) for i in range(len(a))]
        found = np.repeat(a, [len(x) for x in hits]), b[np.concatenate([np.zeros(0, np.int64), *hits])]
        return pa.table({"a": found[0], "b": found[1]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def near_duplicate_classes(docs: DataFrame, similar: float = SIMILAR, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (the smallest id of the class) and n_links (verified links of the row's text).

    Equal texts are one node; null and empty texts form a class of their own. Rows without id are left out.
    """
    plain = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = cut_lineage(plain.withColumn("sum", F.sha2(F.col("text").cast("binary"), 256)).select("doc_id", "sum"))
    nodes = cut_lineage(named.groupBy("sum").agg(F.min("doc_id").alias("key")))
    texts = plain.join(nodes.select("key"), plain.doc_id == nodes.key, "left_semi").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("key"), "text")
    signed = cut_lineage(signatures(texts, "key").withColumnRenamed("doc_id", "key"))
    width = 2 * PERMUTATIONS // BANDS
    bands = F.explode(F.array(*[F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(BANDS)]))
    banded = signed.select("key", "signature", bands.alias("band"))
    sizes = banded.groupBy("band").count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    banded = cut_lineage(banded.join(sizes, "band").withColumn("own", F.pmod(F.xxhash64(F.lit(5), "key"), F.col("blocks")).cast("int")))
    left = banded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("band", "key", "signature", F.col("own").alias("i"), F.col("other").alias("j"))
    right = banded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("band", "key", "signature", F.col("other").alias("i"), F.col("own").alias("j"))
    slack = 3 * math.sqrt(similar * (1 - similar) / PERMUTATIONS)
    likely = left.groupBy("band", "i", "j").cogroup(right.groupBy("band", "i", "j")).applyInArrow(_likely(similar - slack), "a bigint, b bigint").distinct()
    likely = cut_lineage(likely)
    ends = likely.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = cut_lineage(shingle_sets(texts.join(ends, "key", "left_semi")))
    both = likely.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    links = cut_lineage(both.where(common >= F.lit(similar) * (F.size("sa") + F.size("sb") - common)).select("a", "b"))
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
    roots = connected_components(links).withColumnRenamed("node", "key")
    classes = nodes.join(roots, "key", "left").join(degree, "key", "left").select("sum", F.coalesce("root", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return named.join(classes, "sum").select(F.col("doc_id").alias(id), "class_id", "n_links")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: fingerprints and likenesses of every row of documents, as `compare_with_edits` defines them."""
    return compare_with_edits(read_table(spark, sf_dir, "documents"))
