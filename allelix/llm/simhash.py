"""SimHash near-duplicate groups: fingerprints, a binary trie self-join within a Hamming budget, components.

The self-join walks a binary trie against itself: a state is a pair of nodes at one depth with the bits in which they
differ so far; its children pair up the nodes' children, and a pair over the budget is dropped with all below it.
To spread the walk over tasks, the fingerprint is cut into budget + 1 blocks. Two fingerprints within the budget agree
in at least one block, so a walk that starts at nodes with an error-free block, once per block, finds every link. A
bucket of fingerprints with one block in common that is too large for one task is cut again, by blocks of the other
bits, so a hot bucket becomes many; with each cut fewer bits are left free, which bounds what a bucket can hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from allelix.llm.common import compacted, cut_lineage, few_tasks, in_small_batches, read_table, shuffle_width, utf8, word_blocks
from allelix.llm.graph import connected_components

BITS = 64
SEED = 42
#: Of groups that are verified: words of a shingle, Jaccard similarity, and independent fingerprints of each set.
WORDS, SIMILAR, LOOKS = 5, 0.8, 2
#: Differing bits up to which fingerprints are candidates: by the binomial model a pair at 0.8 has 9.7 in the mean and more than 22 once in 10^5.
NEAR = 22
#: Coarse search: differing bits for which its buckets are cut (one of four whole blocks is then equal), and those of its candidates.
COARSE, COARSE_NEAR = 3, 12
#: Candidates that each text sends at least, its nearest ones, beside those that connect groups.
CLOSE = 3
#: Prefix shingles before its own that a row of the last search carries, to tell whether a pair has met before; and rows of one half of a
#: large bucket's pair of blocks.
BEFORE, BLOCK_ROWS = 6, 2048
#: Texts that tell, by a sample, which shingles are frequent, and in how many of them a frequent one is at least.
HOT_TEXTS, HOT_AT = 4096, 4
#: Fingerprints that one bucket may hold before it is cut by further bits.
BUCKET_ROWS = 1024
#: Sum of squared bucket sizes that one call of the trie walk takes.
WALK_PAIRS = 1 << 21
#: Longs that may be broadcast (some 8 MB); more are joined by a shuffle.
FEW = 1 << 18


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every word shingle of the lower-cased text, repeats included, in blocks.

    A text with fewer words has one shingle, all its words; a text without words has none.
    """
    for found, first in word_blocks(text.lower(), words - 1):
        if not found:
            continue
        if len(found) < words:
            if first:
                yield np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], dtype=np.uint64)
            continue
        joined, at, starts, ends = b" ".join(found), 0, [], []
        for size in map(len, found):
            starts.append(at)
            at += size + 1
            ends.append(at - 1)
        shingles = [joined[a:b] for a, b in zip(starts, ends[words - 1 :])]
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=len(shingles))


def majority(blocks: Iterable[np.ndarray]) -> int:
    """Bit i is 1 if over half of the hashes in all blocks have bit i; 0 without hashes."""
    total, ones = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in blocks:
        total += len(hashes)
        for at in range(0, len(hashes), 255 * 256):
            part = hashes[at : at + 255 * 256].astype(">u8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(part, axis=1)
            if rest := -len(bits) % 255:
                bits = np.concatenate([bits, np.zeros((rest, BITS), dtype=np.uint8)])
            ones += np.add.reduce(bits.reshape(-1, 255, BITS), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprint(text: bytes, words: int = 3) -> int:
    """Bit i is 1 if over half of the shingle hashes have bit i; 0 for a text without words."""
    return majority(shingle_hashes(text, words))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, words)]))


def set_key(shingles: np.ndarray) -> int:
    """A signed long that names the shingle set."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def remixed(hashes: np.ndarray, look: int) -> np.ndarray:
    """The hashes for one of several independent fingerprints: the splitmix64 finalizer, but look 0 leaves them."""
    if not look:
        return hashes
    mixed = hashes + np.uint64(look * 0x9E3779B97F4A7C15 % (1 << 64))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `fp`, the fingerprint's bits as a signed long."""
    fields = {f.name: f.dataType for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c].simpleString()}" for c in keep), "fp bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py(), words) for x in batch.column(len(keep))), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found.view(np.int64))], names=[*keep, "fp"])

    return in_small_batches(docs.select(*keep, utf8(text).alias("__text"))).mapInArrow(run, schema)


def trie_walk(starts: np.ndarray, values: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of values within `budget` bits of each other, for buckets of sorted distinct values.

    starts: where each bucket begins, and the end of the last.
    """
    size = np.diff(starts)
    keep = size >= 2
    self_lo, self_hi = starts[:-1][keep], starts[1:][keep]
    cross = np.zeros((5, 0), dtype=np.int64)  # rows: a's range, b's range, differing bits
    left, right = [], []
    for bit in range(BITS - 1, -1, -1):
        if not len(self_lo) and not cross.shape[1]:
            break
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        middle = lambda lo, hi: hi - (ones[hi] - ones[lo])
        grown = []
        if cross.shape[1]:
            a_lo, a_hi, b_lo, b_hi, err = cross
            a_mid, b_mid = middle(a_lo, a_hi), middle(b_lo, b_hi)
            for a0, a1, b0, b1, more in ((a_lo, a_mid, b_lo, b_mid, 0), (a_mid, a_hi, b_mid, b_hi, 0), (a_lo, a_mid, b_mid, b_hi, 1), (a_mid, a_hi, b_lo, b_mid, 1)):
                ok = (a1 > a0) & (b1 > b0) & (err + more <= budget)
                grown.append(np.stack([a0[ok], a1[ok], b0[ok], b1[ok], err[ok] + more]))
        if len(self_lo):
            mid = middle(self_lo, self_hi)
            ok = (mid > self_lo) & (self_hi > mid)
            if budget >= 1:
                grown.append(np.stack([self_lo[ok], mid[ok], mid[ok], self_hi[ok], np.ones(ok.sum(), dtype=np.int64)]))
            lo, hi = np.concatenate([self_lo, mid]), np.concatenate([mid, self_hi])
            self_lo, self_hi = lo[hi - lo >= 2], hi[hi - lo >= 2]
        cross = np.concatenate(grown, axis=1) if grown else cross[:, :0]
        leaf = (cross[1] - cross[0] == 1) & (cross[3] - cross[2] == 1)
        if leaf.any():  # a pair of single values: the bits below are counted at once
            a, b = cross[0][leaf], cross[2][leaf]
            near = np.bitwise_count(values[a] ^ values[b]) <= budget
            left.append(a[near])
            right.append(b[near])
            cross = cross[:, ~leaf]
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the pairs (a, b) connect it with."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, before[a], least)
        np.minimum.at(label, before[b], least)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
        if np.array_equal(label, before):
            break
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def nearest_forest(values: np.ndarray, node: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a, b) those that connect the nodes of their ends as a spanning forest, nearer pairs first."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    order = np.argsort(np.bitwise_count(values[a] ^ values[b]), kind="stable")
    kept = []
    for i, x, y in zip(order.tolist(), node[a[order]].tolist(), node[b[order]].tolist()):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            kept.append(i)
    return a[kept], b[kept]


def nearest_of_each(values: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Whether each of the pairs (a, b) is among the n nearest of one of its ends."""
    ends, pair = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((np.bitwise_count(values[a] ^ values[b])[pair], ends))
    first = np.concatenate([[0], np.flatnonzero(np.diff(ends[order])) + 1])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    out = np.zeros(len(a), dtype=bool)
    out[pair[order[rank < n]]] = True
    return out


def _first_met(diff: np.ndarray, masks: list[int]) -> np.ndarray:
    """For each pair's differing bits the place of the first mask that has none of them."""
    first = np.full(len(diff), len(masks))
    for i, mask in reversed(list(enumerate(masks))):
        first[(diff & np.uint64(mask)) == 0] = i
    return first


def _groups(comp: np.ndarray) -> np.ndarray:
    """A number for each group of a bucket; a value of no single group (-1) is a group by itself."""
    apart = comp == -1
    names = np.empty(len(comp), dtype=np.int64)
    names[~apart] = np.unique(comp[~apart], return_inverse=True)[1]
    names[apart] = len(comp) + np.arange(apart.sum())
    return np.unique(names, return_inverse=True)[1]


def _walk_near(near: int, masks: list[int], crossing: bool):
    """Candidates of buckets (path, fp, first, comp, look), pairs within one comp left out: a spanning forest of each bucket's comps, nearer
    pairs first, and whether other pairs of the same part of the bucket were left out; or, `crossing`, all of them.

    Of the buckets of the first cut in which a pair meets, only that of the first mask gives it.
    """

    def joined(paths: np.ndarray, values: np.ndarray, first: np.ndarray, comp: np.ndarray, look: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.concatenate([[0], np.flatnonzero(np.diff(paths)) + 1, [len(paths)]])
        cuts, total = [0], 0
        for i, n in enumerate(np.diff(starts).tolist()):
            total += n * n
            if total > WALK_PAIRS:
                cuts.append(i + 1)
                total = 0
        for x, y in zip(cuts, [*cuts[1:], len(starts) - 1]):
            if y > x:
                base, end = starts[x], starts[y]
                own, own_comp = values[base:end], comp[base:end]
                a, b = trie_walk(starts[x : y + 1] - base, own, near)
                open_ = (own_comp[a] != own_comp[b]) | (own_comp[a] == -1)
                a, b = a[open_], b[open_]
                met = _first_met(own[a] ^ own[b], masks) == first[base:end][a]
                a, b = a[met], b[met]
                more = np.ones(len(a), dtype=bool)
                if not crossing and len(a):
                    # groups of one bucket each: a comp that is in several buckets has one number in each
                    bucket = np.repeat(np.arange(y - x), np.diff(starts[x : y + 1]))
                    node = np.unique(np.stack([bucket, _groups(own_comp)]), axis=1, return_inverse=True)[1].reshape(-1)
                    label = spanning(len(own), node[a], node[b])
                    links = np.bincount(label[node[a]], minlength=len(own))
                    a, b = nearest_forest(own, node, a, b)
                    kept = np.bincount(label[node[a]], minlength=len(own))
                    more = (links > kept)[label[node[a]]]
                yield pa.RecordBatch.from_arrays([pa.array(look[base:end][a]), pa.array(own[a].view(np.int64)), pa.array(own[b].view(np.int64)), pa.array(more)], names=["look", "a", "b", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64)]
        for batch in batches:
            held = [np.concatenate([x, c.to_numpy().view(x.dtype)]) for x, c in zip(held, batch.columns)]
            if len(held[0]) >= 1 << 17:
                other = np.flatnonzero(held[0] != held[0][-1])
                if len(other):
                    end = int(other[-1]) + 1
                    yield from joined(*(x[:end] for x in held))
                    held = [x[end:] for x in held]
        if len(held[0]):
            yield from joined(*held)

    return run


def _walk_buckets(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, values, squares = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), 0

        def joined(paths: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            starts = np.concatenate([[0], np.flatnonzero(np.diff(paths)) + 1, [len(paths)]])
            size = np.diff(starts)
            cuts, total = [0], 0
            for i, n in enumerate(size.tolist()):
                total += n * n
                if total > WALK_PAIRS:
                    cuts.append(i + 1)
                    total = 0
            out_a, out_b = [], []
            for x, y in zip(cuts, [*cuts[1:], len(size)]):
                if y > x:
                    base, own = starts[x], values[starts[x] : starts[y]]
                    left, right = trie_walk(starts[x : y + 1] - base, own, budget)
                    label = spanning(len(own), left, right)
                    left = np.flatnonzero(label != np.arange(len(own)))
                    right = label[left]
                    out_a.append(own[left].view(np.int64))
                    out_b.append(own[right].view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

        for batch in batches:
            paths = np.concatenate([paths, batch.column(0).to_numpy()])
            values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
            if len(paths) >= 1 << 17:
                end = int(np.searchsorted(paths != paths[-1], False)) if paths[0] != paths[-1] else 0
                end = int(np.flatnonzero(paths != paths[-1])[-1]) + 1 if end else 0
                if end:
                    yield joined(paths[:end], values[:end])
                    paths, values = paths[end:], values[end:]
        if len(paths):
            yield joined(paths, values)

    return run


def _blocks(free: int, budget: int) -> list[tuple[int, list[int]]]:
    """Blocks of `free`, each with the masks made from it; two values within the budget agree in one mask at least.

    Up to a budget of 3 these are budget + 1 blocks, each its own mask. Up to 7, one of four blocks has at most one error, so a block
    gives one mask for each of its bits, without that bit; bits that an earlier cut has left are parted into budget + 1 blocks.
    """
    bits = [1 << i for i in range(BITS - 1, -1, -1) if free >> i & 1]
    wild = 3 < budget < 8 and len(bits) == BITS
    parts = 4 if wild else budget + 1
    ends = [round(i * len(bits) / parts) for i in range(parts + 1)]
    blocks = [sum(bits[a:b]) for a, b in zip(ends, ends[1:])]
    return [(m, [m & ~bit for bit in bits if m & bit] if wild else [m]) for m in blocks]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _table(entries: dict[int, list[int]]) -> Column:
    return F.create_map(*[x for key, masks in entries.items() for x in (F.lit(_signed(key)), F.array(*[F.lit(_signed(m)) for m in masks]))])


def _bucket(value: str) -> Column:
    """The name of the bucket of a row's path and mask."""
    return F.xxhash64("path", "mask", F.col(value).bitwiseAND(F.col("mask")))


def _cut(rows: DataFrame, cuts: dict[int, list[tuple[int, list[int]]]]) -> DataFrame:
    """Each row once for every mask of its free bits; path names the bits fixed so far and their values."""
    table = _table({free: [m for _, masks in blocks for m in masks] for free, blocks in cuts.items()})
    more = [c for c in rows.columns if c not in ("fp", "path", "free")]
    found = rows.select("fp", "path", "free", *more, F.posexplode(F.element_at(table, F.col("free"))).alias("at", "mask"))
    if "first" in more:  # the place of the first cut's mask
        found = found.withColumn("first", F.when(F.col("first") < 0, F.col("at").cast("long")).otherwise(F.col("first")))
    return found.select("fp", _bucket("fp").alias("path"), F.col("free").bitwiseAND(F.bitwise_not("mask")).alias("free"), *more)


def _heavy(rows: DataFrame, cuts: dict[int, list[tuple[int, list[int]]]], bucket_rows: int) -> DataFrame:
    """The paths of the cut's buckets over `bucket_rows`, and of some over half of that.

    Rows are counted by whole blocks, a few for each row. A mask that leaves out one bit of its block joins two values
    of it, so its bucket is within the limit where both have at most half of it.
    """
    per_row = _table({free: [block for block, _ in blocks] for free, blocks in cuts.items()})
    made = {block: masks for blocks in cuts.values() for block, masks in blocks}
    most = bucket_rows if all(masks == [block] for block, masks in made.items()) else bucket_rows // 2
    at = rows.select("fp", "path", F.explode(F.element_at(per_row, F.col("free"))).alias("block"))
    counts = at.groupBy("path", "block", F.col("fp").bitwiseAND(F.col("block")).alias("value")).count().where(F.col("count") > most)
    masked = counts.select("path", "value", F.explode(F.element_at(_table(made), F.col("block"))).alias("mask"))
    return masked.select(_bucket("value").alias("path")).distinct()


def _marked(keys: DataFrame) -> DataFrame | None:
    """The one-column table of longs, written, to be joined with wider rows: broadcast if it is FEW, None if it is empty."""
    keys = cut_lineage(keys)
    n = keys.count()
    keys = few_tasks(keys, n)
    return (F.broadcast(keys) if n <= FEW else keys) if n else None


def hamming_links(values: DataFrame, budget: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b) that connect exactly what the links of the distinct longs `fp` at `budget` or fewer bits connect.

    A task sends a spanning forest of a bucket's links instead of all of them, so a bucket of n fingerprints gives
    under n edges. Buckets over `bucket_rows` are cut by blocks of their free bits, until under 20 bits are free.
    An empty input gives no edges; nulls are left out.
    """
    return _dealt(values.select("fp"), budget, bucket_rows, _walk_buckets(budget), "a bigint, b bigint")


def near_links(values: DataFrame, budget: int = COARSE, near: int = COARSE_NEAR, crossing: bool = False, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pairs (look, a, b, more) of the distinct longs `fp` of one look (with `comp`) that meet in a bucket and differ in at most `near` bits.

    All looks are walked at once, a look being the first part of a bucket's path. Buckets are those in which all pairs of at most `budget` bits meet; further ones meet by chance. See _walk_near for what is sent.
    """
    masks = [m for _, masks in _blocks((1 << BITS) - 1, budget) for m in masks]
    return _dealt(values.select("fp", F.lit(-1).cast("long").alias("first"), "comp", F.col("look").cast("long").alias("look")), budget, bucket_rows, _walk_near(near, masks, crossing), "look bigint, a bigint, b bigint, more boolean")


def _dealt(values: DataFrame, budget: int, bucket_rows: int, walk, schema: str) -> DataFrame:
    edges, frees, more = None, {(1 << BITS) - 1}, values.columns[1:]
    path = F.col("look") if "look" in more else F.lit(0).cast("long")
    rows = cut_lineage(values.where("fp is not null").select("fp", path.alias("path"), F.lit(-1).cast("long").alias("free"), *more))
    while True:
        cuts = {free: _blocks(free, budget) for free in sorted(frees)}
        frees = {free & ~m for free, blocks in cuts.items() for _, masks in blocks for m in masks}
        heavy = None
        if max(free.bit_count() for free in frees) > max(20, budget):
            heavy = _marked(_heavy(rows, cuts, bucket_rows))
        cut = _cut(rows, cuts)
        light = cut if heavy is None else cut.join(heavy, "path", "left_anti")
        unsigned = F.col("fp").bitwiseXOR(F.lit(-(1 << (BITS - 1))))
        dealt = light.select("path", "fp", *more).repartition(shuffle_width(values), "path").sortWithinPartitions("path", unsigned)
        found = dealt.mapInArrow(walk, schema)
        edges = found if edges is None else edges.unionByName(found)
        if heavy is None:
            return edges
        rows = cut_lineage(cut.join(heavy, "path", "left_semi"))


def components(prints: DataFrame, budget: int = 3) -> DataFrame:
    """(fp, component_id) for the table (doc_id, fp): the smallest doc_id that links of `budget` or fewer bits reach.

    Null ids take part in links but name no component; a component without any id has a null one.
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return _named(nodes, connected_components(hamming_links(nodes.select("fp"), budget)), "fp")


def _named(nodes: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    merged = nodes.join(linked.withColumnRenamed("node", key), key)
    roots = merged.groupBy("root").agg(F.min("least").alias("component_id"))
    merged = merged.join(roots, "root").select(key, "component_id")
    return nodes.join(merged, key, "left").select(key, F.coalesce("component_id", "least").alias("component_id"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, budget: int = 3) -> DataFrame:
    """One row for each document: `id`, fingerprint (16 hex digits) and component_id.

    Null and empty texts have fingerprint zero, which is linked like any other. Repeated rows stay. Other columns of
    `docs` are not read, whatever their names.
    """
    prints = cut_lineage(with_fingerprint(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), words=words))
    found = prints.join(components(prints, budget), "fp")
    return found.select(F.col("doc_id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def frequent_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes of shingles that are in HOT_AT or more of some HOT_TEXTS texts, the first by a hash. They only decide an order that
    every set shares; which they are changes costs, not results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(x.as_py(), words).view(np.int64))], names=["shingle"])

    part = F.pmod(F.xxhash64(F.lit(41), "doc_id", "text"), F.lit(max(1, docs.count() // HOT_TEXTS))) == 0
    found = in_small_batches(docs.where(part).select(utf8("text"))).mapInArrow(run, "shingle bigint").groupBy("shingle").count().where(F.col("count") >= HOT_AT)
    return np.sort(np.array([r.shingle for r in found.select("shingle").toLocalIterator()], dtype=np.int64).view(np.uint64))


def prefix(shingles: np.ndarray, hot: np.ndarray, similar: float) -> np.ndarray:
    """The first shingles of a set, frequent ones last, so many that two sets of this Jaccard similarity or more share one of them."""
    at = np.searchsorted(hot, shingles)
    is_hot = np.zeros(len(shingles), dtype=bool)
    is_hot[at < len(hot)] = hot[at[at < len(hot)]] == shingles[at < len(hot)]
    ordered = np.concatenate([shingles[~is_hot], shingles[is_hot]])
    return ordered[: len(shingles) - math.ceil(similar * len(shingles) - 1e-9) + 1] if len(shingles) else ordered


def sketches(docs: DataFrame, words: int, looks: int, similar: float = SIMILAR) -> DataFrame:
    """doc_id, key (the name of the text's shingle set), size of the set, prints (its fingerprints, one for each look) and prefix."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, longs = sent.value, pa.list_(pa.int64())
        for batch in batches:
            keys, sizes, prints, first = [], [], [], []
            for x in batch.column(1):
                found = shingle_set(x.as_py(), words)
                keys.append(set_key(found))
                sizes.append(len(found))
                prints.append(np.array([majority([remixed(found, look)]) for look in range(looks)], dtype=np.uint64).view(np.int64))
                first.append(prefix(found, hot, similar).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints, longs), pa.array(first, longs)], names=["doc_id", "key", "size", "prints", "prefix"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(docs.select("doc_id", utf8("text"))).mapInArrow(run, f"doc_id {ids}, key bigint, size bigint, prints array<bigint>, prefix array<bigint>")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """key and shingles (sorted distinct hashes) of every distinct shingle set of the table (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py(), words) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(map(set_key, sets), pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["key", "shingles"])

    return in_small_batches(texts.select(utf8("text"))).mapInArrow(run, "key bigint, shingles array<bigint>").dropDuplicates(["key"])


def _by_print(nodes: DataFrame, looks: int) -> tuple[DataFrame, DataFrame]:
    """(key, root, look, fp) of nodes (key, prints, root) for the first looks; and (look, fp, comp): the root, -1 where keys of one
    fingerprint have several."""
    at = cut_lineage(nodes.select("key", "root", F.posexplode(F.slice("prints", 1, looks)).alias("look", "fp")))
    one = F.when(F.min("root") == F.max("root"), F.min("root")).otherwise(F.lit(-1).cast("long"))
    return at, cut_lineage(at.groupBy("look", "fp").agg(one.alias("comp"), F.min("key").alias("top"), F.count_distinct("root").alias("n")))


def _candidates(nodes: DataFrame, looks: int, budget: int, near: int) -> DataFrame:
    """Pairs (a, b, more) of keys (key, prints, root) that connect, beside the roots, all candidates of each look; more tells that others are left out.

    Keys with one fingerprint are linked to the least of them, which links of the fingerprint lead to, unless their roots are one.
    """
    at, tops = _by_print(nodes, looks)
    links = near_links(tops.select("look", "fp", "comp"), budget, near)
    end = lambda c: tops.select("look", F.col("fp").alias(c), F.col("top").alias(f"k{c}"), F.col("n").alias(f"n{c}"))
    named = links.join(end("a"), ["look", "a"]).join(end("b"), ["look", "b"])
    heads = at.join(tops.where("n > 1").select("look", "fp", F.col("top").alias("key")), ["look", "fp", "key"]).select("look", "fp", F.col("key").alias("top"), F.col("root").alias("head"))
    equal = at.join(heads, ["look", "fp"]).where("root <> head").select(F.col("top").alias("a"), F.col("key").alias("b"), F.lit(True).alias("more"))
    return named.select(F.col("ka").alias("a"), F.col("kb").alias("b"), F.expr("more or na > 1 or nb > 1").alias("more")).unionByName(equal)


def _member_pairs(fp: np.ndarray, comp: np.ndarray, starts: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of rows of one bucket whose fingerprints differ in at most `near` bits, but not of one comp. Rows are in order of
    (bucket, fingerprint); starts: where buckets begin, and the end."""
    head = np.ones(len(fp), dtype=bool)
    head[1:] = fp[1:] != fp[:-1]
    head[starts[:-1]] = True
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(fp)))
    one = np.minimum.reduceat(comp, first) == np.maximum.reduceat(comp, first)
    name = np.where(one, comp[first], -1)
    a, b = trie_walk(np.searchsorted(first, starts), fp[first], near)
    same = np.flatnonzero((size > 1) & (name == -1))
    a, b = np.concatenate([a, same]), np.concatenate([b, same])
    keep = (name[a] != name[b]) | (name[a] == -1)
    a, b = a[keep], b[keep]
    # all rows of one fingerprint with all of the other
    na, nb = size[a], size[b]
    pair = np.repeat(np.arange(len(a)), na * nb)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    x, y = first[a][pair] + place // nb[pair], first[b][pair] + place % nb[pair]
    open_ = (comp[x] != comp[y]) & ((a[pair] != b[pair]) | (x < y))
    return x[open_], y[open_]


def _met_before(before: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of each pair share one of the prefix shingles right before the bucket's own (zero: none). Such a pair meets in that shingle's
    bucket too, and so in the end in the bucket of one of its shared shingles that has none before it."""
    out = np.zeros(len(a), dtype=bool)
    for i in range(before.shape[1]):
        left = before[a, i]
        for j in range(before.shape[1]):
            out |= (left != 0) & (left == before[b, j])
    return out


def _walk_prefix(near: int, similar: float, crossing: bool):
    """Candidates of buckets (path, fp, key, comp, place, before ...) of one shingle of prefixes: key pairs of different comps whose fingerprints are
    near and whose sizes and places of the shingle allow the similarity. A spanning forest of each bucket's comps, nearer pairs first, with the nearest
    few of each row, and whether others were left out; or, `crossing`, all of them, each about once: a pair that shares one of the shingles before is left to that shingle's bucket.
    place holds the size of the set, the shingle's position in the prefix and the side: rows of sides 0 and 1 are paired with each other only, rows of
    side 2 with all."""
    def joined(path: np.ndarray, fp: np.ndarray, key: np.ndarray, comp: np.ndarray, place: np.ndarray, *before: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
        mixed = np.minimum.reduceat(comp, starts[:-1]) != np.maximum.reduceat(comp, starts[:-1])
        rows = np.repeat(mixed, np.diff(starts))
        fp, key, comp, place = (x[rows] for x in (fp, key, comp, place))
        size, pos, side = place >> 34, place >> 2 & 0xFFFFFFFF, place & 3
        earlier = np.stack([x[rows] for x in before], axis=1) if before else None
        count = np.diff(starts)[mixed]
        starts = np.concatenate([[0], np.cumsum(count)])
        cuts, total = [0], 0
        for i, n in enumerate(count.tolist()):
            total += n * n
            if total > WALK_PAIRS:
                cuts.append(i + 1)
                total = 0
        for x, y in zip(cuts, [*cuts[1:], len(count)]):
            if y <= x:
                continue
            base, end = starts[x], starts[y]
            own, names, group, sizes, at = (z[base:end] for z in (fp, key, comp, size, pos))
            a, b = _member_pairs(own, group, starts[x : y + 1] - base, near)
            sides = side[base:end]
            open_ = (sides[a] != sides[b]) | (sides[a] == 2)
            if earlier is not None:
                open_ &= ~_met_before(earlier[base:end], a, b)
            a, b = a[open_], b[open_]
            least, most = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
            common = np.minimum(sizes[a] - at[a], sizes[b] - at[b])  # this shingle and all behind it
            able = (least >= similar * most - 1e-9) & (common >= similar / (1 + similar) * (sizes[a] + sizes[b]) - 1e-9)
            a, b = a[able], b[able]
            more = np.ones(len(a), dtype=bool)
            if not crossing and len(a):
                bucket = np.repeat(np.arange(y - x), np.diff(starts[x : y + 1]))
                node = np.unique(np.stack([bucket, np.unique(group, return_inverse=True)[1]]), axis=1, return_inverse=True)[1].reshape(-1)
                label = spanning(len(own), node[a], node[b])
                links = np.bincount(label[node[a]], minlength=len(own))
                close = nearest_of_each(own, a, b, CLOSE)
                c, d = nearest_forest(own, node, a, b)
                a, b = np.unique(np.stack([np.concatenate([a[close], c]), np.concatenate([b[close], d])]), axis=1)
                more = (links > np.bincount(label[node[a]], minlength=len(own)))[label[node[a]]]
            yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b]), pa.array(more)], names=["a", "b", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.uint64 if i == 1 else np.int64) for i in range(5 + (BEFORE if crossing else 0))]
        for batch in batches:
            held = [np.concatenate([x, c.to_numpy().view(x.dtype)]) for x, c in zip(held, batch.columns)]
            if len(held[0]) >= 1 << 17:
                other = np.flatnonzero(held[0] != held[0][-1])
                if len(other):
                    end = int(other[-1]) + 1
                    yield from joined(*(x[:end] for x in held))
                    held = [x[end:] for x in held]
        if len(held[0]):
            yield from joined(*held)

    return run


def _prefix_candidates(nodes: DataFrame, near: int, similar: float, crossing: bool = False, block_rows: int = BLOCK_ROWS, look: int = 0) -> DataFrame:
    """Pairs (a, b, more) of keys (key, root, size, prints, prefix) with different roots that share a shingle of their prefixes and have near
    fingerprints (of one look): what connects the roots, or, `crossing`, all of them.

    A shingle's bucket with several roots and more than twice `block_rows` rows is cut into blocks by key, and every pair of blocks is a bucket, so
    that no pair is lost and none is in two.
    """
    before = [F.coalesce(F.get("prefix", F.col("pos") - i), F.lit(0)).cast("long").alias(f"before{i}") for i in range(1, BEFORE + 1)] if crossing else []
    rows = nodes.select("key", F.col("root").alias("comp"), "size", F.col("prints")[look].alias("fp"), "prefix", F.posexplode("prefix").alias("pos", "path"))
    place = F.shiftleft(F.col("size").cast("long"), 34) + F.shiftleft(F.col("pos").cast("long"), 2) + 2
    rows = rows.select("path", "fp", "key", "comp", place.alias("place"), *before)
    # most shingles are in one row: only their counts are sent, and whether there are several roots is asked for large ones
    counted = rows.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block_rows)
    large = compacted(counted.select("path", F.ceil(F.col("n") / block_rows).cast("long").alias("blocks")))
    unsigned = F.col("fp").bitwiseXOR(F.lit(-(1 << (BITS - 1))))

    def walk(df: DataFrame) -> DataFrame:
        return df.repartition(shuffle_width(nodes), "path").sortWithinPartitions("path", unsigned, "key").mapInArrow(_walk_prefix(near, similar, crossing), "a bigint, b bigint, more boolean")

    n = large.count()
    if n:
        large = F.broadcast(large) if n <= FEW else large
        mixed = rows.join(large, "path").groupBy("path", "blocks").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
        large = compacted(mixed.select("path", "blocks"))
        n = large.count()
    if not n:
        return walk(rows)
    large = F.broadcast(large) if n <= FEW else large
    own, other = F.pmod(F.xxhash64(F.lit(43), "key"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cut = rows.join(large, "path").select(*rows.columns, own.alias("own"), other.alias("other"))
    pair = F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 0).otherwise(F.when(F.col("own") < F.col("other"), 2).otherwise(1))  # taken from side 2
    cut = cut.select(pair.alias("path"), *rows.columns[1:4], (F.col("place") - side).alias("place"), *rows.columns[5:])
    return walk(rows.join(large.select("path"), "path", "left_anti")).unionByName(walk(cut))


def most_bits(similar: float, bits: int) -> int:
    """Differing bits of `bits` that a pair of this Jaccard similarity has at most, but for one in some 10^8 by the binomial model."""
    p = math.acos(2 * similar / (1 + similar)) / math.pi
    return math.ceil(bits * p + 6 * math.sqrt(bits * p * (1 - p)))


def _verified(links: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, similar: float, looks: int) -> DataFrame:
    """The links whose shingle sets are `similar` or more (Jaccard). Texts are read only where the sets' sizes and all
    fingerprints together allow it."""
    end = lambda c: nodes.select(F.col("key").alias(c), F.col("size").alias(f"n{c}"), F.col("prints").alias(f"p{c}"))
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col("pa")[i].bitwiseXOR(F.col("pb")[i])) for i in range(looks)])
    able = links.select("a", "b").join(end("a"), "a").join(end("b"), "b").where(F.least("na", "nb") >= F.lit(similar) * F.greatest("na", "nb"))
    links = compacted(able.where(apart <= most_bits(similar, looks * BITS)).select("a", "b"))
    ends = links.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(nodes.select("key", F.col("least").alias("doc_id")), "key")
    ids = _marked(ends.select("doc_id").distinct())
    if ids is None:
        return links
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    sets = cut_lineage(shingle_sets(texts, words))
    both = links.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return compacted(both.where(common >= F.lit(similar) * (F.size("sa") + F.size("sb") - common)).select("a", "b"))


def _ordered(links: DataFrame, *more) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *more)


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes with root, the least key that the links reach. Where few keys are linked, nodes, which are wide, are neither shuffled nor written again."""
    roots = cut_lineage(connected_components(links).withColumnRenamed("node", "key"))
    few = (n := roots.count()) <= FEW // 2
    roots = few_tasks(roots, n)
    rooted = nodes.join(F.broadcast(roots) if few else roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    return rooted if few else cut_lineage(rooted)


def _apart(rooted: DataFrame, links: DataFrame) -> DataFrame | None:
    """The nodes of groups that may have links among the pairs that were left out: pairs were left out only beside links marked so (`more`), and one whose
    ends are still apart has a failed such link at both groups. None if there are none."""
    root = lambda c: rooted.select(F.col("key").alias(c), F.col("root").alias(f"r{c}"))
    failed = links.where("more").join(root("a"), "a").join(root("b"), "b").where("ra <> rb")
    found = _marked(failed.select(F.explode(F.array("ra", "rb")).alias("root")).distinct())
    return None if found is None else cut_lineage(rooted.join(found, "root", "left_semi"))


def _grouped(docs: DataFrame, words: int, similar: float, looks: int, near: int) -> DataFrame:
    """doc_id, key (of its shingle set) and root (least key of the group) of every row that has a doc_id."""
    docs = docs.where("doc_id is not null")
    found = cut_lineage(sketches(docs, words, looks, similar))
    firsts = [F.first(c).alias(c) for c in ("size", "prints", "prefix")]
    nodes = cut_lineage(found.groupBy("key").agg(F.min("doc_id").alias("least"), *firsts))
    # First the pairs of one look that agree in one of a few whole blocks: they join most of a large group, so that the full search, which
    # sends only what connects different groups, has little left to send.
    alone = nodes.withColumn("root", F.col("key"))
    links = compacted(_ordered(_candidates(alone, 1, COARSE, COARSE_NEAR), "more").groupBy("a", "b").agg(F.max("more").alias("more")))
    good = _verified(links, docs, nodes, words, similar, looks)
    rooted = _rooted(nodes, good)
    links = compacted(_ordered(_prefix_candidates(rooted, near, similar), "more").groupBy("a", "b").agg(F.max("more").alias("more")))
    good = compacted(good.unionByName(_verified(links, docs, nodes, words, similar, looks)))
    rooted = _rooted(nodes, good)
    left = _apart(rooted, links)
    for look in range(1, looks if left is not None else 1):  # nearest ones by another look, so that fewer groups are left to the last search
        again = compacted(_ordered(_prefix_candidates(left, near, similar, look=look)).distinct().join(links.select("a", "b"), ["a", "b"], "left_anti"))
        good = compacted(good.unionByName(_verified(again, docs, nodes, words, similar, looks)))
        rooted = _rooted(nodes, good)
        left = _apart(rooted, links)
    if left is not None:
        rest = compacted(_ordered(_prefix_candidates(left, near, similar, True)).distinct().join(links.select("a", "b"), ["a", "b"], "left_anti"))
        rooted = _rooted(nodes, good.unionByName(_verified(rest, docs, nodes, words, similar, looks)))
    return found.select("doc_id", "key").join(rooted.select("key", "root"), "key")


def verified_groups(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR, looks: int = LOOKS, near: int = NEAR) -> DataFrame:
    """(doc_id, component_id): groups by links between texts whose sets of `words`-word shingles are `similar` or more (Jaccard).

    Two such sets share a shingle among the first of each in one common order, frequent ones last; so the fingerprints of the sets are
    bucketed by these shingles, and in each bucket the trie is walked against itself: pairs that differ in at most `near` bits are candidates,
    if sizes and places of the shingle allow the similarity. A large bucket is compared by pairs of its blocks, so none is lost there. A passage that many texts share comes last in the order, so it brings together
    only texts that are little else. Repeats of a shingle do not count. Texts with equal shingle sets, and so all without words, are in one
    group. First what connects the groups of a bucket is verified, nearest first; then all others whose ends are still in different groups. Null ids are
    left out; an empty table gives no rows.
    """
    found = cut_lineage(_grouped(docs, words, similar, looks, near))
    names = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(names, "root").select("doc_id", "component_id")


def _keyed(docs: DataFrame, words: int) -> DataFrame:
    """`docs` with __key, the name of each text's shingle set."""
    at, names = docs.columns.index("text"), [*docs.columns, "__key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [set_key(shingle_set((x.as_py() or "").encode(), words)) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=names)

    return in_small_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField("__key", LongType())]))


def one_of_each(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR, looks: int = LOOKS, near: int = NEAR) -> DataFrame:
    """The rows of `docs` (with doc_id and text) without near copies: of each group the row with the least doc_id.

    Rows with one doc_id are decided each by its own text; of a group's rows with the least doc_id the one with the
    least shingle set's name and then the least text stays. A row without doc_id cannot be named by a decision, so it
    stays. All columns are kept.
    """
    found = cut_lineage(_grouped(docs, words, similar, looks, near))
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    decided = found.join(first, "root").select("doc_id", "key", (F.struct("doc_id", "key") == F.col("first")).alias("stays"))
    ids = cut_lineage(decided.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("stays").alias("stays")))
    gone = _marked(ids.where("rows > 1 or not stays").select("doc_id"))
    kept = docs if gone is None else docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    again = _marked(ids.where("rows > 1 and stays").select("doc_id"))
    if again is None:
        return kept
    stay = decided.where("stays").select("doc_id", F.col("key").alias("__key")).distinct().join(again, "doc_id", "left_semi")
    rows = _keyed(docs.join(again, "doc_id", "left_semi").select(docs.columns), words).join(stay, ["doc_id", "__key"], "left_semi")
    least = F.min_by(F.struct(*docs.columns), F.struct(F.col("text").isNull(), "text"))
    return kept.unionByName(rows.groupBy("doc_id", "__key").agg(least.alias("row")).select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: fingerprint and component of every row of documents, as `near_duplicates` defines them."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
