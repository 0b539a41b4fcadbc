"""Genomic interval overlap as an equi-join on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 1_000_000


def _binned(df: DataFrame, start: str, end: str, size: int) -> DataFrame:
    return df.withColumn("__first", F.floor(F.col(start) / size)).withColumn("__bin", F.explode(F.sequence("__first", F.floor(F.col(end) / size))))


def overlap_join(left: DataFrame, right: DataFrame, chrom: tuple[str, str], starts: tuple[str, str], ends: tuple[str, str], size: int = BIN) -> DataFrame:
    """Pairs on one chromosome that overlap, ends included.

    Each side is exploded into its bins and joined on (chromosome, bin); a pair that shares several bins counts only in the later of
    the two first bins, so nothing has to be made distinct. Choose `size` near the usual length: longer intervals cost a row a bin.
    """
    a = _binned(left.where(F.col(starts[0]) <= F.col(ends[0])), starts[0], ends[0], size).withColumnsRenamed({"__first": "__fa", "__bin": "__ba"})
    b = _binned(right.where(F.col(starts[1]) <= F.col(ends[1])), starts[1], ends[1], size).withColumnsRenamed({"__first": "__fb", "__bin": "__bb"})
    same: Column = (F.col(chrom[0]) == F.col(chrom[1])) & (F.col("__ba") == F.col("__bb"))
    hit = (F.col(starts[0]) <= F.col(ends[1])) & (F.col(starts[1]) <= F.col(ends[0])) & (F.col("__ba") == F.greatest("__fa", "__fb"))
    return a.join(b, same & hit).drop("__fa", "__fb", "__ba", "__bb")


#: Bits of the bin sizes of the levels that `overlap_join_of_any_length` uses, each 16 times the one before.
LEVELS = (14, 18, 22, 26, 30)


def _level(start: str, end: str) -> Column:
    """The place of the smallest bins that an interval is not longer than; the last level's for longer ones."""
    length = F.col(end) - F.col(start) + 1
    out = F.lit(len(LEVELS) - 1)
    for i, bits in reversed(list(enumerate(LEVELS))):
        out = F.when(length <= (1 << bits), i).otherwise(out)
    return out


def _at_level(level: Column, start: str, end: str) -> tuple[Column, Column]:
    """The first and the last bin of a level that an interval lies in."""
    size = F.element_at(F.array(*[F.lit(1 << bits) for bits in LEVELS]), level + 1)
    return F.floor(F.col(start) / size), F.floor(F.col(end) / size)


def _placed(df: DataFrame, start: str, end: str, side: str, climbs: bool) -> DataFrame:
    """Each interval in the bins of its own level, or, `climbs`, in those of every level from its own up; at most two bins of each, but of the last."""
    own = df.where(F.col(start) <= F.col(end)).withColumn(f"__own_{side}", _level(start, end))
    level = F.explode(F.sequence(F.col(f"__own_{side}"), F.lit(len(LEVELS) - 1))) if climbs else F.col(f"__own_{side}")
    at = own.withColumn(f"__level_{side}", level)
    first, last = _at_level(F.col(f"__level_{side}"), start, end)
    return at.withColumn(f"__first_{side}", first).withColumn(f"__bin_{side}", F.explode(F.sequence(F.col(f"__first_{side}"), last)))


def overlap_join_of_any_length(left: DataFrame, right: DataFrame, chrom: tuple[str, str], starts: tuple[str, str], ends: tuple[str, str]) -> DataFrame:
    """Pairs on one chromosome that overlap, ends included, for intervals of one position up to whole chromosomes.

    An interval belongs to the level whose bins are as long as itself, and lies in at most two of them. The shorter of a pair climbs to the level of the
    longer, where both meet in a common bin; of two common bins the later first one counts. So an interval gives at most two rows for each level, however
    long it is, where bins of one size would give a row for each bin. Which of the two is longer is not known beforehand, so there are two joins: the left
    climbs to right ones of its level or above, and the right to left ones strictly above. A bin with many intervals is a skewed key of a sort-merge
    join, which adaptive execution splits.
    """
    def met(a: DataFrame, b: DataFrame, above: Column) -> DataFrame:
        same = (F.col(chrom[0]) == F.col(chrom[1])) & (F.col("__level_a") == F.col("__level_b")) & (F.col("__bin_a") == F.col("__bin_b"))
        hit = (F.col(starts[0]) <= F.col(ends[1])) & (F.col(starts[1]) <= F.col(ends[0])) & (F.col("__bin_a") == F.greatest("__first_a", "__first_b"))
        return a.join(b, same & hit & above).select(*left.columns, *right.columns)

    up = met(_placed(left, starts[0], ends[0], "a", True), _placed(right, starts[1], ends[1], "b", False), F.lit(True))
    down = met(_placed(left, starts[0], ends[0], "a", False), _placed(right, starts[1], ends[1], "b", True), F.col("__own_b") < F.col("__own_a"))
    return up.unionByName(down)


def chunks(df: DataFrame, start: str, end: str, span: int) -> DataFrame:
    """Each region cut into parts of at most `span` positions: part_start, part_end."""
    cut = df.withColumn("part_start", F.explode(F.sequence(F.col(start), F.col(end), F.lit(span).cast("long"))))
    return cut.withColumn("part_end", F.least(F.col("part_start") + span - 1, F.col(end)))


def with_fallback(left: DataFrame, key: str, local: DataFrame, fallback: DataFrame) -> DataFrame:
    """Local hits, and hits of the fallback for rows of `left` without any."""
    open_ = left.join(local.select(key).distinct(), key, "left_anti")
    return local.unionByName(fallback.join(open_.select(key), key, "left_semi"))
