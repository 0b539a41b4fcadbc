"""Delimited files in zip archives, and first lines of files of any kind, read as streams inside tasks.

An archive is opened where its task runs, by the file system that its path names, and its member is decompressed block by block: no file is
ever a row, so members may have any size and nothing but one batch of rows is held. A member is one partition, as deflated data cannot be
split. The driver learns names of files, never content.
"""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import json
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows of a batch, and characters of a first line at most.
ROWS, LONGEST_LINE = 5000, 1 << 20
DELIMITERS = (",", "\t", "|", ";")


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path
    return pyarrow.fs.FileSystem.from_uri(path)


def opens(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open paths of this kind by themselves; a path without scheme is of the session's default file system."""
    scheme = urlsplit(path).scheme or urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).scheme
    return scheme in ("file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss")


def chosen_member(archive: zipfile.ZipFile, file: str, member: str | None = None) -> zipfile.ZipInfo:
    """The member of that name, or the only one."""
    members = [m for m in archive.infolist() if not m.is_dir()]
    if not members:
        raise FileNotFoundError(f"{file} holds no member")
    if member:
        named = [m for m in members if m.filename == member]
        if not named:
            raise FileNotFoundError(f"{file} has no member {member}")
        return named[0]
    if len(members) != 1:
        raise ValueError(f"{file} holds {len(members)} members instead of one: {', '.join(m.filename for m in members[:5])}")
    return members[0]


@contextmanager
def text_stream(file: str, member: str | None = None, encoding: str = "utf-8-sig") -> Iterator[io.TextIOBase]:
    """The text of a plain, gzipped or zipped file, as a stream; a byte-order mark is taken off, line ends are left as they are."""
    system, path = _place(file)
    with system.open_input_file(path) as raw:
        if file.lower().endswith(".gz"):
            with gzip.open(raw, "rt", encoding=encoding, newline="") as text:
                yield text
        elif file.lower().endswith(".zip"):
            with zipfile.ZipFile(raw) as archive, archive.open(chosen_member(archive, file, member)) as body, io.TextIOWrapper(body, encoding, newline="") as text:
                yield text
        else:
            with io.TextIOWrapper(raw, encoding, newline="") as text:
                yield text


def first_line(file: str, member: str | None = None) -> str:
    """The first line, without its end, reading no further than the block that holds it."""
    with text_stream(file, member) as text:
        return text.readline(LONGEST_LINE).rstrip("\r\n")


def delimiter_of(line: str) -> str:
    """The commonest of the known delimiters, the first of them in a tie or where there is none."""
    return max(DELIMITERS, key=lambda d: (line.count(d), -DELIMITERS.index(d)))


def records(file: str, member: str | None, delimiter: str, columns: list[str], strict: bool = False, keep_broken: bool = True) -> Iterator[list[str | None]]:
    """The values of `columns` of each record, quoted by ". Unquoted empty fields, missing columns and what a short record lacks are null. A record
    of another length is kept, dropped, or an error if `strict`."""
    with text_stream(file, member) as text:
        rows = csv.reader(text, delimiter=delimiter, quotechar='"', doublequote=True, quoting=csv.QUOTE_NOTNULL, strict=strict)
        header = [(c or "").strip() for c in next(rows, [])]
        place = {c: i for i, c in reversed(list(enumerate(header)))}
        at = [place.get(c) for c in columns]
        for row in rows:
            if not row:
                continue
            if len(row) != len(header):
                if strict:
                    raise ValueError(f"{file}: a record of {len(row)} fields under {len(header)} columns")
                if not keep_broken:
                    continue
            yield [row[i] if i is not None and i < len(row) else None for i in at]


class _Member(InputPartition):
    def __init__(self, file: str, member: str | None, delimiter: str):
        self.file, self.member, self.delimiter = file, member, delimiter


class _Reader(DataSourceReader):
    def __init__(self, columns: list[str], options: dict[str, str]):
        self.columns, self.options = columns, options

    def partitions(self) -> list[_Member]:
        return [_Member(*m) for m in json.loads(self.options["members"])]

    def read(self, partition: _Member) -> Iterator[pa.RecordBatch]:
        own = [c for c in self.columns if c != "source_file"]
        mode = self.options.get("mode", "permissive")
        held: list[list[str | None]] = []

        def batch() -> pa.RecordBatch:
            by_name = dict(zip(own, zip(*held)))
            values = [[partition.file] * len(held) if c == "source_file" else list(by_name[c]) for c in self.columns]
            return pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in values], names=self.columns)

        for row in records(partition.file, partition.member, partition.delimiter, own, mode == "failfast", mode != "dropmalformed"):
            held.append(row)
            if len(held) == ROWS:
                yield batch()
                held = []
        if held:
            yield batch()


class ZippedTables(DataSource):
    """spark.read.format("zipped_tables"): string columns of delimited members, one partition each.

    Options: members, a JSON list of [file, member or null, delimiter]; mode (permissive, dropmalformed, failfast). The schema names the columns wanted,
    and source_file.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_tables"

    def reader(self, schema) -> _Reader:
        return _Reader(schema.names, dict(self.options))


def zipped_tables(spark: SparkSession, members: list[tuple[str, str | None, str]], columns: list[str], strict: bool = False, keep_broken: bool = True) -> DataFrame:
    """The columns, as strings, of members (file, member or None for the only one, delimiter), with source_file."""
    spark.dataSource.register(ZippedTables)
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, "source_file"])
    mode = "failfast" if strict else "permissive" if keep_broken else "dropmalformed"
    return spark.read.format("zipped_tables").option("members", json.dumps(members)).option("mode", mode).schema(ddl).load()


def first_lines(files: DataFrame, per_task: int = 256) -> DataFrame:
    """(file, line, error) of each file in the column `file`, plain, gzipped or zipped with one member; a file that cannot be read has a null line and
    its error. Of each file one block is read, whatever its size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, errors = [], []
            for file in batch.column(0).to_pylist():
                try:
                    lines.append(first_line(file))
                    errors.append(None)
                except (OSError, ValueError, zipfile.BadZipFile, EOFError, UnicodeDecodeError) as error:
                    lines.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string()), pa.array(errors, pa.string())], names=["file", "line", "error"])

    return files.select("file").distinct().mapInArrow(run, "file string, line string, error string")


def archive_members(files: DataFrame) -> DataFrame:
    """(file, member, bytes, packed) of the zip archives in the column `file`; only their directories are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for file in batch.column(0).to_pylist():
                system, path = _place(file)
                with system.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                    out += [(file, m.filename, m.file_size, m.compress_size) for m in archive.infolist() if not m.is_dir()]
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["file", "member", "bytes", "packed"])

    return files.select("file").mapInArrow(run, "file string, member string, bytes bigint, packed bigint")


def write_zipped(df: DataFrame, folder: str, name: str, delimiter: str = ",") -> DataFrame:
    """Write each partition as the only member of an archive of its own below `folder`: a header, then records quoted where needed; null is an unquoted
    empty field. Gives (file) of the archives. A task writes aside and renames, so a repeated task leaves no half archive."""
    columns = df.columns
    system, path = _place(folder)
    system.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        at = f"{folder.rstrip('/')}/{name}-{context.partitionId():05d}.csv.zip"
        system, place = _place(at)
        aside = f"{place}.{context.taskAttemptId()}.part"
        with system.open_output_stream(aside) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive, archive.open(f"{name}.csv", "w", force_zip64=True) as member, io.TextIOWrapper(member, "utf-8", newline="") as text:
            out = csv.writer(text, delimiter=delimiter, quoting=csv.QUOTE_NOTNULL, lineterminator="\n")
            out.writerow(columns)
            for batch in batches:
                out.writerows(zip(*(c.to_pylist() for c in batch.columns)))
        system.move(aside, place)
        yield pa.RecordBatch.from_arrays([pa.array([at])], names=["file"])

    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return df.sparkSession.createDataFrame([(r.file,) for r in text.mapInArrow(run, "file string").collect()], "file string")


def digests(files: DataFrame, block: int = 1 << 20) -> DataFrame:
    """(file, sha256) of the files in the column `file`, read block by block where their task runs, so of any size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file in batch.column(0).to_pylist():
                system, path = _place(file)
                told = hashlib.sha256()
                with system.open_input_stream(path, compression=None) as raw:
                    while part := raw.read(block):
                        told.update(part)
                found.append(told.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["file", "sha256"])

    return files.select("file").mapInArrow(run, "file string, sha256 string")
