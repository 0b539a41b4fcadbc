"""Files as tables: listing, delimiter choice, JSON maps, per-gene artifacts, archives. Listing reads no content."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.sources import archives
from allelix.sources.readers import TABLES, columns_of, delimited, header_inventory, header_of


def expanded(paths: str | Sequence[str]) -> list[str]:
    """Paths with variables and ~ replaced, each once, in order; globs and folders are Spark's to expand."""
    given = [paths] if isinstance(paths, str) else list(paths)
    return list(dict.fromkeys(os.path.expanduser(os.path.expandvars(p.strip())) for p in given if p.strip()))


def input_files(spark: SparkSession, paths: str | Sequence[str], pattern: str = TABLES) -> DataFrame:
    """(file, name, bytes, modified) of the files at files, folders and globs; the content column is pruned, so nothing is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(expanded(paths))
    return found.select(F.col("path").alias("file"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def headers(spark: SparkSession, names: DataFrame) -> DataFrame:
    """(file, delimiter, columns, fingerprint, error) of the files in the column `file`, plain, gzipped or zipped: see `readers.header_of`."""
    return header_of(archives.first_lines(names))


def tables(spark: SparkSession, heads: DataFrame, strict: bool = False, keep_broken: bool = True) -> DataFrame:
    """The files of a header inventory (file, delimiter, columns) as strings with source_file, columns united by name.

    Plain and gzipped files are read by Spark, one read for each header that occurs, so that a plain file is split; archives are read
    member by member. The driver learns names and headers of the files, as for any list of files.
    """
    plain: dict[tuple, list[str]] = {}
    zipped: list[tuple[str, None, str]] = []
    order: dict[str, None] = {}
    for r in heads.select("file", "delimiter", "columns").orderBy("file").toLocalIterator():
        if r.file.lower().endswith(".zip"):
            zipped.append((r.file, None, r.delimiter))
            order |= dict.fromkeys(r.columns)
        else:
            plain.setdefault((r.delimiter, tuple(r.columns)), []).append(r.file)
    parts = [delimited(spark, own, d, strict, keep_broken) for (d, _), own in sorted(plain.items())]
    if zipped:
        parts.append(archives.zipped_tables(spark, zipped, [c for c in order if c and c != "source_file"], strict, keep_broken))
    if not parts:
        raise FileNotFoundError("no file to read")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def sniffed(spark: SparkSession, paths: str | Sequence[str], delimiter: str = "auto", strict: bool = False, keep_broken: bool = True) -> DataFrame:
    """Delimited files, plain, gzipped or zipped, as strings with source_file. `auto` takes each file's delimiter from its header; `comma` and `tab` fix it.
    Of folders and globs only tables by their names are taken, a file that is named is taken whatever its name. A file that cannot be read is an error, as
    is a path without files."""
    given = expanded(paths)
    named = [p for p in given if re.search(r"\.\w+$", p.rpartition("/")[2]) and not re.search(r"[*?{\[]", p)]
    parts = [header_inventory(spark, own, pattern) for own, pattern in ((named, "*"), ([p for p in given if p not in named], TABLES)) if own]
    if not parts:
        raise FileNotFoundError(f"no path in {paths!r}")
    heads = reduce(DataFrame.unionByName, parts)
    broken = heads.where("error is not null").first()
    if broken is not None:
        raise ValueError(f"{broken.file}: {broken.error}")
    if delimiter != "auto":
        heads = heads.withColumn("delimiter", F.lit({"comma": ",", "tab": "\t"}.get(delimiter, delimiter)))
        heads = heads.withColumn("columns", columns_of(F.col("line"), F.col("delimiter")))
    return tables(spark, heads, strict, keep_broken)


def zipped_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the lines of zip archives with a single member, decompressed as a stream."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with archives.text_stream(file) as stream:
                    while held := [line.rstrip("\r\n") for line in itertools.islice(stream, 10_000)]:
                        yield pa.RecordBatch.from_arrays([pa.array([file] * len(held)), pa.array(held, pa.string())], names=["file", "value"])

    return input_files(spark, path, "*.zip").select("file").mapInArrow(lines, "file string, value string")


def json_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(key, value) of JSON objects, one for each file or, with `lines`, one for each line, which files of any size can be split at; values stay
    JSON text, strings without quotes."""
    rows = spark.read.text(path, wholetext=not lines).select(F.explode(F.from_json("value", "map<string,string>")))
    return rows.select("key", "value")


def expression_entries(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(gene_id, entry) of an expression map."""
    return json_map(spark, path, lines).select(F.col("key").alias("gene_id"), F.col("value").alias("entry"))


def gene_seed(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, gene_location, strand, biotype, canonical_transcript) of a metadata map; blank fields are null."""
    return seed_fields(json_map(spark, path))


def seed_fields(entries: DataFrame) -> DataFrame:
    """The gene fields of (key, value) rows whose value is a JSON object."""
    given = lambda k: F.nullif(fn.strip(F.get_json_object("value", f"$.{k}")), F.lit(""))
    transcript = F.get_json_object("value", "$.canonical_transcript")
    return entries.select(F.col("key").alias("gene_id"), given("gene_location").alias("gene_location"), fn.to_int(given("strand")).alias("strand"), given("biotype").alias("biotype"), F.when(~transcript.isin("[]", ""), transcript).alias("canonical_transcript"))


def _decoded(name):
    """A percent-encoded name; Spark encodes file names once more."""
    return F.url_decode(F.url_decode(name))


def artifact_files(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, gene_id_normalized, payload, source_path) of JSON files named by percent-encoded gene, plain or gzipped; of a gene's files,
    in any case of letters, one stays: gzipped first, then by name. Hidden and metadata files are left out.

    Which files stay is decided by their names alone; payloads meet only the list of names that stay, and are not grouped.
    """
    place = F.col("_metadata.file_path")
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").option("recursiveFileLookup", True).load(path).select(place.alias("source_path"), F.col("_metadata.file_name").alias("name"))
    shown = names.where(~F.col("name").rlike(r"^(\.|metadata\.)")).select(
        _decoded(F.regexp_extract("name", r"^(.*?)\.json(\.gz)?$", 1)).alias("gene_id"), F.col("name").endswith(".gz").alias("zipped"), F.lit(None).cast("string").alias("payload"), "source_path"
    )
    chosen = newest_first(shown).drop("payload")
    texts = spark.read.option("pathGlobFilter", "*.json*").option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("value").alias("payload"), place.alias("source_path"))
    return texts.join(chosen, "source_path").select("gene_id", "gene_id_normalized", "payload", "source_path")


def newest_first(rows: DataFrame) -> DataFrame:
    """One row for each gene in any case of letters: gzipped first, then by gene name."""
    best = rows.groupBy(F.upper("gene_id").alias("gene_id_normalized")).agg(F.max_by(F.struct("gene_id", "payload", "source_path"), F.struct("zipped", "gene_id")).alias("x"))
    return best.select("x.gene_id", "gene_id_normalized", "x.payload", "x.source_path")


def shared_lists(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, type, name, entry) of a folder {cvd,trait}/<name>.json, each file an object by gene."""
    file = F.col("_metadata.file_path")
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    rows = rows.select(F.lower(F.regexp_extract(file, "/([^/]+)/[^/]+$", 1)).alias("type"), _decoded(F.regexp_extract(file, r"/([^/]+)\.json$", 1)).alias("name"), F.explode(F.from_json("value", "map<string,string>")).alias("gene_id", "entry"))
    return rows.where(F.col("type").isin("cvd", "trait")).select("gene_id", "type", "name", "entry")


def isoform_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(protein_id, length_aa, source_file) of isoform tables, comma or tab by each file's header."""
    rows = sniffed(spark, paths)
    length = [fn.to_int(F.col(c)) for c in ("max", "protein_length") if c in rows.columns]
    return rows.select(F.nullif(fn.strip(F.col("protein_id")), F.lit("")).alias("protein_id"), (F.coalesce(*length) if length else F.lit(None).cast("bigint")).alias("length_aa"), "source_file").where("protein_id is not null")
