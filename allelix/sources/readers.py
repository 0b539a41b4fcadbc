"""Readers: delimited association files, GTF, JSON payloads. All columns are read as strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.sources import archives


#: File names that are taken for delimited tables in folders.
TABLES = "*.{csv,csv.gz,csv.zip}"


def columns_of(line: Column, delimiter: Column) -> Column:
    """The column names of a header line, without white space and quotes around them."""
    return F.transform(F.split(line, F.concat(F.lit("\\Q"), delimiter, F.lit("\\E"))), lambda c: F.regexp_replace(fn.strip(c), '^"|"$', ""))


def header_of(lines: DataFrame) -> DataFrame:
    """(file, line, delimiter, columns, fingerprint, error) of first lines (file, line, error); the delimiter is the commonest of , tab | ; in the line."""
    counted = F.array(*[F.struct(F.length(F.regexp_replace("line", f"[^{p}]", "")).alias("n"), F.lit(-i).alias("order"), F.lit(d).alias("d")) for i, (d, p) in enumerate(((",", ","), ("\t", "\t"), ("|", "|"), (";", ";")))])
    cut = lines.withColumn("delimiter", F.array_max(counted)["d"])
    return cut.select("file", "line", "delimiter", columns_of(F.col("line"), F.col("delimiter")).alias("columns"), "error").withColumn("fingerprint", F.sha2(F.to_json("columns"), 256))


def header_inventory(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """file, line, delimiter, columns, fingerprint and error of every file's header, as `header_of` has them.

    Of each file only its first block is read, in a task that opens it. Where only Spark can open the path, the first line of each plain or gzipped
    file comes from a text scan.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    if all(archives.opens(spark, path) for path in given):
        listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(given).select(F.col("path").alias("file"))
        return header_of(archives.first_lines(listed))
    rows = spark.read.option("pathGlobFilter", pattern).text(given).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("n"))
    return header_of(rows.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("line")).withColumn("error", F.lit(None).cast("string")))


def delimited(spark: SparkSession, paths: Sequence[str], delimiter: str = ",", strict: bool = False, keep_broken: bool = True) -> DataFrame:
    """Files with a header, quoted by ", as strings with source_file. Short rows are padded with nulls; `strict` fails on
    a broken row, and `keep_broken=False` drops it."""
    mode = "FAILFAST" if strict else "PERMISSIVE" if keep_broken else "DROPMALFORMED"
    read = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("sep", delimiter).option("mode", mode).csv(list(paths))
    return read.withColumn("source_file", F.col("_metadata.file_path"))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Genes, transcripts and exons of GTF files: coordinates, strand, ids without version, exon number and tags."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in ((0, "chrom"), (2, "feature"), (3, "start"), (4, "end"), (6, "strand"), (8, "attributes"))])
    known = rows.where(F.col("feature").isin("gene", "transcript", "exon")).withColumn("a", fn.gtf_attributes(F.col("attributes")))
    one = lambda k: F.get(F.col("a")[k], F.lit(0))
    return known.select(
        fn.chromosome(F.col("chrom")).alias("chrom"), "feature", fn.to_int(F.col("start")).alias("start"), fn.to_int(F.col("end")).alias("end"), fn.strand(F.col("strand")).alias("strand"),
        fn.without_version(one("gene_id")).alias("gene_id"), one("gene_name").alias("gene_name"), fn.without_version(one("transcript_id")).alias("transcript_id"),
        fn.to_int(one("exon_number")).alias("exon_number"), F.col("a")["tag"].alias("tags"),
    )
