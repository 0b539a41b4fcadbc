"""Sharding by fixed virtual slots: records hash to slots, slots map to shards, and only the map is ever edited.

The slot of a record depends on its id, its text's checksum and the number of slots, which never change. What is balanced is a table of
one row per slot (its bytes and rows); its size is the slot count, whatever the data. A map from slots to shards is
kept in versions: rebalancing writes a new version in which as few slots as possible move.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, read_table

SLOTS = 4096
SHARDS = 16


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: shard of each slot, and the bytes and rows that each slot had when it was drawn up."""

    version: int
    shards: int
    shard_of: tuple[int, ...]
    bytes_of: tuple[int, ...]
    rows_of: tuple[int, ...]

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for shard, size in zip(self.shard_of, self.bytes_of):
            out[shard] += size
        return out

    def rows(self) -> list[tuple[int, int, int, int, int, int]]:
        """(version, shards, slot, shard, bytes, rows) of each slot, the form in which a map is stored."""
        return [(self.version, self.shards, i, *x) for i, x in enumerate(zip(self.shard_of, self.bytes_of, self.rows_of))]


MAP_SCHEMA = "version int, shards int, slot int, shard int, bytes bigint, rows bigint"


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    """The fixed virtual slot of a key of one or more columns; nulls count as nothing."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def _fill(sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """Largest slot first, each to the lightest shard."""
    heap, out = [(0, s) for s in range(shards)], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i][0], -sizes[i][1], i)):
        load, shard = heapq.heappop(heap)
        out[i] = shard
        heapq.heappush(heap, (load + sizes[i][0], shard))
    return out


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) of each slot, from the columns `size` and `virtual_slot`; one row per slot reaches the driver."""
    out = [(0, 0)] * slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect():
        out[r.virtual_slot] = (r.bytes, r.rows)
    return out


def draw_up(sizes: list[tuple[int, int]], shards: int = SHARDS, version: int = 1) -> SlotMap:
    """A new map with near-equal bytes in each shard."""
    return SlotMap(version, shards, tuple(_fill(sizes, shards)), tuple(b for b, _ in sizes), tuple(n for _, n in sizes))


def rebalance(old: SlotMap, sizes: list[tuple[int, int]], shards: int | None = None, tolerance: float = 0.01) -> SlotMap:
    """The next version for new slot sizes or more shards.

    Slots leave only shards that are over the mean by more than `tolerance`, for the lightest shard, the largest slot
    that fits first; every other slot stays where it is. A smaller count of shards empties the last ones.
    """
    shards = shards or old.shards
    shard_of = list(old.shard_of)
    loads = [0] * shards
    homeless = []
    for i, s in enumerate(shard_of):
        if s < shards:
            loads[s] += sizes[i][0]
        else:
            homeless.append(i)
    own: list[list[int]] = [[] for _ in range(shards)]
    for i, s in enumerate(shard_of):
        if s < shards:
            own[s].append(i)

    def move(i: int, to: int) -> None:
        shard_of[i] = to
        loads[to] += sizes[i][0]
        own[to].append(i)

    for i in sorted(homeless, key=lambda i: (-sizes[i][0], i)):
        move(i, min(range(shards), key=lambda s: (loads[s], s)))
    mean = sum(loads) / shards
    for _ in range(len(shard_of)):
        most, least = max(range(shards), key=lambda s: (loads[s], -s)), min(range(shards), key=lambda s: (loads[s], s))
        if loads[most] <= mean * (1 + tolerance):
            break
        room = min(loads[most] - mean, mean - loads[least])
        fits = [i for i in own[most] if 0 < sizes[i][0] <= max(room, 0)] or [
            i for i in own[most] if 0 < sizes[i][0] < loads[most] - loads[least]
        ]
        if not fits:
            break
        best = max(fits, key=lambda i: (sizes[i][0], -i)) if room > 0 else min(fits, key=lambda i: (sizes[i][0], i))
        own[most].remove(best)
        loads[most] -= sizes[best][0]
        move(best, least)
    return replace(old, version=old.version + 1, shards=shards, shard_of=tuple(shard_of), bytes_of=tuple(b for b, _ in sizes), rows_of=tuple(n for _, n in sizes))


def save(spark: SparkSession, table: SlotMap, path: str) -> None:
    """Add a version to the store at `path`, one folder per version; an older version is never changed."""
    spark.createDataFrame(table.rows(), MAP_SCHEMA).coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the latest by default."""
    stored = spark.read.parquet(path)
    version = version if version is not None else stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).orderBy("slot").collect()
    return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows), tuple(r.bytes for r in rows), tuple(r.rows for r in rows))


def records(docs: DataFrame, id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and one; 1 for a null text), text_crc32 (0 for a null text) and virtual_slot.

    A row's slot comes from its id and its text's checksum, so that texts under one id, or under none, spread too."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        slot_of(F.col(id).cast("string"), F.crc32(body), slots=slots).alias("virtual_slot"),
    )


def place(found: DataFrame, table: SlotMap) -> DataFrame:
    """`records` with shard, and slot: the place inside the shard, gapless from 0.

    The shard's virtual slots lie one after the other, so a place is the count of rows in the slots before plus the
    rank inside the slot; no task sorts a whole shard. The map and the counts are literals of one entry per slot.
    """
    before, seen = [], [0] * table.shards
    for shard, rows in zip(table.shard_of, table.rows_of):
        before.append(seen[shard])
        seen[shard] += rows
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    return found.select(
        "*",
        F.get(F.lit(list(table.shard_of)), F.col("virtual_slot")).cast("int").alias("shard"),
        (F.get(F.lit(before), F.col("virtual_slot")).cast("long") + rank).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, table: SlotMap | None = None, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, SlotMap]:
    """Every row of `docs` with its shard, by near-equal bytes, and the map used.

    With `table` its shards hold, sizes being counted anew. Rows with one id and one text share a slot.
    An empty table gives no rows. Other columns are not read, whatever their names.
    """
    found = cut_lineage(records(docs, id, text, slots))
    sizes = slot_sizes(found, slots)
    if table is None:
        table = draw_up(sizes, shards)
    else:
        table = replace(table, bytes_of=tuple(b for b, _ in sizes), rows_of=tuple(n for _, n in sizes))
    return place(found, table), table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every row of documents in a shard of near-equal bytes, as `shard_documents` defines them.

    Ties between slots go by their number, rows of one slot stand in order of id, checksum and size; repeated rows have places of their own.
    """
    placed, table = shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(table.version).alias("map_version"))
