"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: Spark's value where none is set: 64 MB.
BATCH_DEFAULT = "67108864b"
#: Narrow rows (a few longs each) that one task takes.
TASK_ROWS = 1 << 15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where it is unset, a temporary folder serves a session that runs in one process, as in tests; a cluster gets an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-checkpoint-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from the files."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """`df`, of at most so many rows, in as few partitions as they need: a shuffle makes files for each partition that it reads."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def compacted(df: DataFrame) -> DataFrame:
    """`cut_lineage`, read by few tasks where few rows came out."""
    df = cut_lineage(df)
    return few_tasks(df, df.count())


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, to be handed to Python in Arrow batches of at most BATCH_BYTES, or of one longer row.

    Spark's own limit lets a batch of long texts take tens of MB several times over, in the JVM and in the worker. The
    setting is the session's; a value other than Spark's default is left.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    return df


def utf8(column: str):
    """The column's UTF-8 bytes; null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def word_blocks(text: bytes, carry: int, block: int = 1 << 20) -> Iterator[tuple[list[bytes], bool]]:
    """The words (runs without ASCII white space) of `text`, in lists of bounded size.

    Each list after the first begins with the last `carry` words before it, so that every run of carry + 1
    words lies whole in exactly one list. The flag tells whether the list is the first.
    """
    if len(text) <= block:
        yield text.split(), True
        return
    at, kept, first = 0, [], True
    while at < len(text):
        cut = _SPACE.search(text, at + block) if at + block < len(text) else None
        end = cut.start() if cut else len(text)
        words, at = kept + text[at:end].split(), end
        if len(words) > carry or at == len(text):
            yield words, first
            first, kept = False, words[len(words) - carry :] if carry else []
        else:
            kept = words
