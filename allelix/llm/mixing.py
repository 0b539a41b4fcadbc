"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source's documents lie in a hash order. Equal hash prefixes make blocks, up to 1,024 to deal for a source. A source's target
gives whole passes over its blocks and a rest; the rest is the first blocks of the order, and in the block where it
ends single documents fill what is left. So each source has an exact quota of block draws. The tree shares the quotas
among the output shards: at each node the multivariate hypergeometric distribution draws how many of each source's
blocks go left, the others go right. Each shard takes its own range of the source's permuted block draws, so no draw
is used twice, and orders its rows by a hash.

One row for each source reaches the driver; documents never do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, in_small_batches, read_table, utf8, word_blocks

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 20240607
SHARDS = 16
#: Documents that a block to deal, and a block to fill up singly, should have at least; bits by which one round cuts.
DEAL_ROWS = 8
BLOCK_ROWS = 64
ROUND_BITS = 10
HASH_BITS = 62


#: Rows of a table by source that may be broadcast (a few MB); larger ones are joined by a shuffle.
FEW = 1 << 15


def _small(table: DataFrame, rows: int) -> DataFrame:
    """A table of as many rows, one for each source at most, to be joined with documents."""
    return F.broadcast(table) if rows <= FEW else table


def targets(words: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Target words of each source, the sources being in order: weights repeat, and a target stops at `most` times the
    source's words, the excess being shared again by weight until no target is above."""
    weight = [weights[i % len(weights)] for i in range(len(words))]
    total, open_ = share * sum(words), set(range(len(words)))
    out = [0.0] * len(words)
    while open_:
        rate = total / sum(weight[i] for i in open_)
        full = {i for i in open_ if rate * weight[i] > most * words[i]}
        if not full:
            for i in open_:
                out[i] = rate * weight[i]
            break
        for i in full:
            out[i] = most * words[i]
            total -= out[i]
        open_ -= full
    return out


def splitting_tree(quotas: Sequence[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): each source's quota shared among shards whose totals differ by one at most."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(first: int, last: int, left: np.ndarray) -> None:
        if last - first == 1:
            out[first] = left
            return
        middle = (first + last) // 2
        total = int(left.sum())
        draw = total * (middle - first) // (last - first)
        taken = rng.multivariate_hypergeometric(left, draw, method="marginals") if total else left
        split(first, middle, taken)
        split(middle, last, left - taken)

    if len(quotas):
        split(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def word_count(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns `keep` and `size`, the count of runs without ASCII white space (null text: 0)."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [sum(len(words) for words, _ in word_blocks(x.as_py(), 0)) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(size, pa.int64())], names=[*keep, "size"])

    return in_small_batches(docs.select(*keep, utf8(text).alias("__text"))).mapInArrow(run, ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "size bigint"]))


def _order(id: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id)), 64 - HASH_BITS)


def _prefix(bits: Column) -> Column:
    return F.expr("0").cast("long") if bits is None else F.call_function("shiftright", F.col("place"), (F.lit(HASH_BITS) - bits).cast("int"))


def _boundaries(found: DataFrame, sources: list[dict]) -> None:
    """For each source with a rest: the blocks before `prefix` (of `bits` bits) are in it, and `need` words of that block.

    A block with many documents is cut again by further bits, so the last block of each source is small unless its
    documents share one id.
    """
    spark = found.sparkSession
    few = len(sources)
    open_ = {s["no"]: {"bits": 0, "prefix": 0, "rows": s["rows"], "need": s["rest"]} for s in sources}
    more = dict(open_)
    while more := {no: x for no, x in more.items() if x["need"] > 0 and x["rows"] >= 2 * BLOCK_ROWS and x["bits"] < HASH_BITS - 2}:
        rows = []
        for no, x in more.items():
            x["step"] = min(ROUND_BITS, HASH_BITS - x["bits"], int(np.log2(x["rows"] / BLOCK_ROWS)))
            rows.append((no, x["bits"], x["prefix"], x["bits"] + x["step"]))
        cut = spark.createDataFrame(rows, "no int, bits int, prefix bigint, next int")
        inside = found.join(_small(cut, few), "no").where(_prefix(F.col("bits")) == F.col("prefix"))
        sums = inside.groupBy("no", _prefix(F.col("next")).alias("block")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        run = F.sum("words").over(Window.partitionBy("no").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
        needs = spark.createDataFrame([(no, float(x["need"])) for no, x in more.items()], "no int, need double")
        last = (
            sums.withColumn("run", run).join(_small(needs, few), "no").where("run >= need").groupBy("no")
            .agg(F.min_by(F.struct("block", "words", "rows", "run"), "block").alias("x")).select("no", "x.*")
        )
        hit = {r.no: r for r in last.collect()}
        for no, x in more.items():
            r = hit[no]
            x |= {"need": x["need"] - (r.run - r.words), "bits": x["bits"] + x["step"], "prefix": r.block, "rows": r.rows}
    for s in sources:
        s |= open_[s["no"]]


def _fill(group: pd.DataFrame) -> pd.DataFrame:
    """Documents of a source's last block that come nearest to the words left, larger ones first."""
    left, chosen = float(group["need"].iloc[0]), []
    rows = group.sort_values(["words", "place"], ascending=[False, True])
    skipped = None
    for no, place, words in zip(rows["no"], rows["place"], rows["words"]):
        if 0 < words <= left:
            chosen.append((no, place))
            left -= words
        elif words > 0:
            skipped = (no, place, words)
    if skipped and abs(skipped[2] - left) < left:
        chosen.append(skipped[:2])
    return pd.DataFrame(chosen, columns=["no", "place"]).astype({"no": "int32", "place": "int64"})


def plan_mix(found: DataFrame, shards: int = SHARDS, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """What to draw, from the table (source, place, size): one row per source, and the chosen documents of last blocks."""
    spark = found.sparkSession
    stats = found.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).collect()
    sources = [{"no": i, "source": r.source, "words": r.words, "rows": r.rows, "total_rows": r.rows} for i, r in enumerate(sorted(stats, key=lambda r: (r.source is None, r.source or "")))]
    for s, target in zip(sources, targets([s["words"] for s in sources], weights, share, most)):
        whole = int(target // s["words"]) if s["words"] else 0
        s |= {"target": target, "passes": whole, "rest": target - whole * s["words"]}
        if s["rest"] < 0.5:
            s["rest"] = 0.0
    names = _small(spark.createDataFrame([(s["no"], s["source"]) for s in sources], "no int, name string"), len(sources))
    numbered = found.join(names, F.col("source").eqNullSafe(F.col("name"))).select("no", "place", "size")
    _boundaries(numbered, sources)
    for s in sources:
        s["block_bits"] = min(ROUND_BITS, int(np.log2(max(1, s["total_rows"] / DEAL_ROWS))))
        s["blocks"], more = 1 << s["block_bits"], s["bits"] - s["block_bits"]
        s["partial"] = ((s["prefix"] >> more) + 1 if more >= 0 else (s["prefix"] + 1) << -more) if s["need"] > 0 else 0
    tree = splitting_tree([s["passes"] * s["blocks"] + s["partial"] for s in sources], shards, np.random.default_rng(SEED))
    ends = np.cumsum(tree, axis=0)
    table = spark.createDataFrame(
        [(s["no"], s["source"], s["words"], s["target"], s["passes"], s["bits"], s["prefix"] if s["need"] > 0 else 0, float(s["need"]), s["block_bits"], s["blocks"], ends[:, s["no"]].tolist()) for s in sources],
        "no int, name string, source_size bigint, target double, passes int, bits int, prefix bigint, need double, block_bits int, blocks int, ends array<bigint>",
    )
    last = numbered.join(_small(table.where("need > 0").select("no", "bits", "prefix", "need"), len(sources)), "no").where(_prefix(F.col("bits")) == F.col("prefix"))
    last = last.groupBy("no", "place").agg(F.sum("size").alias("words"), F.first("need").alias("need"))
    chosen = last.groupBy("no").applyInPandas(_fill, "no int, place bigint")
    chosen = cut_lineage(chosen)  # a hundred rows or so for each source: documents are not shuffled to meet them
    return _small(table, len(sources)), _small(chosen, chosen.count())


def draws(found: DataFrame, table: DataFrame, chosen: DataFrame) -> DataFrame:
    """`found` (source, place, any others) with source_size, target and mix_shards: the output shard of each copy drawn."""
    picked = chosen.select(F.col("no").alias("__no"), F.col("place").alias("__place"))
    joined = found.join(table, F.col("source").eqNullSafe(F.col("name"))).join(picked, (F.col("no") == F.col("__no")) & (F.col("place") == F.col("__place")), "left")
    block = _prefix(F.col("block_bits"))
    odd = lambda turn: F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("no"), turn), 40) * 2 + 1
    whole = F.transform(
        F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(F.array().cast("array<int>")),
        lambda turn: turn * F.col("blocks") + F.pmod(block * odd(turn) + odd(turn + 1000), F.col("blocks")),
    )
    in_rest = (F.col("need") > 0) & ((_prefix(F.col("bits")) < F.col("prefix")) | F.col("__no").isNotNull())
    rest = F.when(in_rest, F.array(F.col("passes") * F.col("blocks") + block)).otherwise(F.array().cast("array<bigint>"))
    shard_of = lambda i: F.size(F.filter("ends", lambda end: end <= i))
    mixed = F.transform(F.concat(whole, rest), shard_of)
    return joined.withColumn("mix_shards", mixed).drop("no", "name", "passes", "bits", "prefix", "need", "block_bits", "blocks", "ends", "__no", "__place")


def measured(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source, size and place (the hash order) of every row."""
    plain = docs.select(F.col(id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    return word_count(plain, ("doc_id", "source")).withColumn("place", _order("doc_id"))


def mix(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: the rows of `docs`, each once for every copy drawn, with mix_shard and mix_order.

    Write it by `repartition(mix_shard)` and `sortWithinPartitions(mix_shard, mix_order)`. Rows with equal ids share
    their fate; null ids hash alike and do too. A null source is a source of its own, ordered last; a null or empty text
    has no words. An empty table gives no rows.
    """
    found = cut_lineage(measured(docs, id, source, text))
    table, chosen = plan_mix(found, shards, weights, share, most)
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), F.col(source).cast("string").alias("source"), F.xxhash64(F.lit(SEED), F.col(id)).alias("__hash"))
    keyed = keyed.select("__row", "source", F.shiftrightunsigned("__hash", 64 - HASH_BITS).alias("place"))
    out = draws(keyed, table, chosen).select("__row", F.posexplode("mix_shards").alias("__copy", "mix_shard"))
    return out.select("__row.*", "mix_shard", F.xxhash64(F.lit(SEED), F.col("__copy"), F.col(f"__row.{id}")).alias("mix_order"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: size, source_size, target and taken of every row of documents.

    A null text has no words; rows with one id share their fate, null ids too; an empty table gives no rows.
    """
    found = cut_lineage(measured(read_table(spark, sf_dir, "documents")))
    out = draws(found, *plan_mix(found))
    return out.select("doc_id", "size", "source_size", "target", (F.size("mix_shards") * F.col("size")).cast("long").alias("taken"), "mix_shards")
