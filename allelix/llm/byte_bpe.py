"""Byte-level BPE by a file of ranks, over overlapping chunks.

A text is cut into chunks of CHUNK bytes, each read OVERLAP bytes further. Every chunk is pre-tokenised by itself, wherever its row lies.
Two neighbours are stitched at the first pre-token boundary that both give in their overlap and that no match of the pattern
can cross: behind a letter or a digit before a character of another class, or before white space. Such a boundary is right whatever the
text to its left, so stitches do not hang on each other; where an overlap has none (a run of letters longer than it), the two
chunks are joined to one piece. The pieces between stitches are encoded, again each by itself, and their ids put one after the
other. Decoding puts the tokens' bytes one after the other.

A text of one chunk has no overlap: it is pre-tokenised and encoded in its own row and never shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.llm import bpe
from allelix.llm.common import in_small_batches, read_table

CHUNK, OVERLAP = 16384, 512
#: Characters that must follow a boundary inside a chunk's window for it to be certain: a match looks no further ahead.
AHEAD = 4
#: Boundaries that no match crosses, whatever lies before: after these characters a match goes on only with its own class.
SURE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=\P{White_Space})(?=\p{White_Space})")


class Ranks(bpe.Vocabulary):
    """A vocabulary of byte strings by rank: two neighbours merge if their bytes together are a token, which is then their rank."""

    def __init__(self, spec: bytes):
        rank = {base64.b64decode(token): int(n) for token, n in (line.split() for line in spec.splitlines() if line)}
        if any(bytes([b]) not in rank for b in range(256)):
            raise ValueError("no byte-level ranks: a byte has no token")
        self.special, self.cut, self.memory = {}, None, {}
        self.bytes_of = {n: token for token, n in rank.items()}
        self.of_byte = np.array([rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [(rank[t[:i]] << 32 | rank[t[i:]], n) for t, n in rank.items() for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
        key, merged = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.merged = key[order], merged[order], merged[order]
        self.words = regex.compile(bpe.WORDS)
        self.whole: dict[str, bytes] = {}
        for token, n in rank.items():
            try:
                self.whole[token.decode()] = n.to_bytes(4, "little")
            except UnicodeDecodeError:
                continue

        self.small = max(self.bytes_of) < 1 << 16
        # by id, in lists: what digests take of each token
        self.decimals = [str(n) for n in range(max(self.bytes_of) + 1)]
        self.tokens = [self.bytes_of.get(n) for n in range(max(self.bytes_of) + 1)]

    def packed(self, ids: bytes) -> bytes:
        """Ids (32 bits each) as they are sent between tasks: in 16 bits, if all of the vocabulary's fit."""
        return np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes() if self.small else ids

    def numbers(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype="<u2" if self.small else "<u4")

    def learn(self, words: set[str]) -> None:
        """Merge the words that are not yet remembered; a word that is a token by itself is never merged."""
        own = words & self.whole.keys()
        super().learn(words - own)
        self.memory.update((w, self.whole[w]) for w in own)


_loaded: dict[str, Ranks] = {}


def _vocabulary(docs: DataFrame, path: str) -> Callable[[], Ranks]:
    """A function that gives the vocabulary on an executor; the file, of fixed size, is read on the driver."""
    with open(path, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def get() -> Ranks:
        if path not in _loaded:
            _loaded[path] = Ranks(spec.value)
        return _loaded[path]

    return get


def chunk_marks(vocabulary: bpe.Vocabulary, body: bytes, first: bool, last: bool, overlap: int = OVERLAP) -> tuple[list[int], list[int]]:
    """Sure boundaries of a chunk's own pre-tokens: those in its first and those in its last `overlap` bytes, as places in `body`.

    The first chunk of a text has no overlap before it, the last none behind. A character that the window cuts is left out.
    """
    start = 0 if first else next((i for i in range(min(4, len(body))) if body[i] & 0xC0 != 0x80), 0)
    end = len(body) if last else bpe._whole(body)
    text = body[start:end].decode("utf-8", "replace")
    words = [w for part in vocabulary.cut_words(text) for w in part]
    head, tail = [], []
    if not first:
        at, place = start, 0
        for w in words:
            if at >= overlap:
                break
            if place and SURE.match(text, place):
                head.append(at)
            at, place = at + len(w.encode()), place + len(w)
    if not last:
        at, place = end, len(text)
        for w in reversed(words):
            at, place = at - len(w.encode()), place - len(w)
            if at < len(body) - overlap:
                break
            if place and place + AHEAD <= len(text) and SURE.match(text, place):
                tail.append(at)
    return head, tail[::-1]


def _body(text: str):
    """The text's UTF-8 bytes, broken ones as replacement characters; null counts as the empty text."""
    return F.coalesce(F.make_valid_utf8(F.col(text).cast("string")), F.lit("")).cast("binary")


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(__key, __n, id, __body, __last, __copies) of (id, __text): overlapping chunks, spread over tasks by text and number. Repeats of a row are one."""
    size = F.octet_length("__text")
    key = F.sha2(F.concat(F.when(F.col("id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"), F.lit("\0"))).cast("binary"), "__text"), 256)
    count = F.ceil((size - overlap) / chunk).cast("int")
    cut = long.select("id", "__text", key.alias("__key"), (count - 1).alias("__end"), F.explode(F.sequence(F.lit(0), count - 1)).alias("__n"))
    one = cut.select("id", "__key", "__n", (F.col("__n") == F.col("__end")).alias("__last"), F.substring("__text", F.col("__n") * chunk + 1, F.lit(chunk + overlap)).alias("__body"))
    return one.groupBy("__key", "__n").agg(F.first("id").alias("id"), F.first("__body").alias("__body"), F.first("__last").alias("__last"), F.count("*").alias("__copies"))


def long_pieces(long: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(__key, id, __copies, __piece, __ids) of the texts (id, __text) of more than one chunk, __ids as `Ranks.packed` gives them.

    Chunks are dealt by text and number, so one huge text is many tasks' work. Only places of boundaries meet by text.
    """
    get = _vocabulary(long, path)
    chunks = _chunks(long, chunk, overlap)
    kind = dict(chunks.dtypes)["id"]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            key, n, body, last = batch.columns
            found = [chunk_marks(vocabulary, b.as_py(), i == 0, end, overlap) for i, b, end in zip(n.to_pylist(), body, last.to_pylist())]
            at = [i * chunk for i in n.to_pylist()]
            sides = [pa.array([[a + p for p in f[side]] for a, f in zip(at, found)], pa.list_(pa.int64())) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([key, n, *sides], names=["__key", "__n", "head", "tail"])

    light = chunks.select("__key", "__n", "__body", "__last").mapInArrow(marks, "__key string, __n int, head array<bigint>, tail array<bigint>")
    by = Window.partitionBy("__key").orderBy("__n")
    stitched = light.withColumn("cut", F.when(F.col("__n") == 0, 0).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(by), "head"))).cast("bigint"))
    so_far, later = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(1, Window.unboundedFollowing)
    places = stitched.select(
        "__key", "__n", F.max(F.when(F.col("cut").isNotNull(), F.col("__n"))).over(so_far).alias("__piece"), F.max("cut").over(so_far).alias("__from"), F.min("cut").over(later).alias("__to"),
        (F.col("cut").isNotNull() & F.lead("cut", 1, 0).over(by).isNotNull()).alias("__alone"),
    )
    pieces = chunks.join(places, ["__key", "__n"])
    schema, names = f"__key string, id {kind}, __copies bigint, __piece int, __ids binary", ["__key", "id", "__copies", "__piece", "__ids"]

    def part_of(body: bytes, piece: int, start: int, end: int | None) -> str:
        base = piece * chunk
        return body[start - base : len(body) if end is None else end - base].decode("utf-8", "replace")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            texts = [part_of(b.as_py(), n, start, end) for b, n, start, end in zip(batch.column(3), batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist())]
            ids = [vocabulary.packed(x) for x in vocabulary.encode_many(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(4), pa.array(ids, pa.binary())], names=names)

    def joined(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__n")
        vocabulary = get()
        piece, start, end, copies = (rows.column(n)[0].as_py() for n in ("__piece", "__from", "__to", "__copies"))
        bodies = [b.as_py() for b in rows.column("__body")]
        text = part_of(b"".join([*(b[:chunk] for b in bodies[:-1]), bodies[-1]]), piece, start, end)
        ids = vocabulary.packed(b"".join(vocabulary.encode(text)))
        return pa.table([rows.column("__key").slice(0, 1), rows.column("id").slice(0, 1), pa.array([copies], pa.int64()), pa.array([piece], pa.int32()), pa.array([ids], pa.binary())], names=names)

    # a piece of one chunk is encoded where its row lies; only chunks that are joined to one piece are brought together
    one = pieces.where("__alone").select("__key", "id", "__copies", "__body", "__piece", "__from", "__to").mapInArrow(alone, schema)
    return one.unionByName(pieces.where("not __alone").groupBy("__key", "__piece").applyInArrow(joined, schema))


def _parted(docs: DataFrame, id: str, text: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(id, __text) of the texts of one chunk, and of those of more."""
    rows = docs.select(F.col(id).alias("id"), _body(text).alias("__text"))
    small = F.octet_length("__text") <= chunk + overlap
    return in_small_batches(rows.where(small)), in_small_batches(rows.where(~small))


class _Digest:
    """The digests of one text, fed with its ids in order."""

    def __init__(self) -> None:
        self.n, self.ids, self.text = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, vocabulary: Ranks, ids: np.ndarray) -> None:
        numbers = ids.tolist()
        if numbers:
            self.ids.update((("," if self.n else "") + ",".join(map(vocabulary.decimals.__getitem__, numbers))).encode())
            self.text.update(b"".join(map(vocabulary.tokens.__getitem__, numbers)))
            self.n += len(numbers)

    def values(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`id`, n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256 (of the decoded bytes) of every row.

    A null text counts as the empty text, which has no ids. Repeated rows stay, each with its own result row; a null id is kept; no other
    column is read, whatever its name; an empty table gives no rows. Broken UTF-8 is read as replacement characters. Ids of a
    text of several chunks are hashed piece by piece and never held together.
    """
    get = _vocabulary(docs, path)
    short, long = _parted(docs, id, text, chunk, overlap)
    kind = docs.schema[id].dataType.simpleString()
    schema, names = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", ["id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def batch_of(ids: pa.Array, found: list[tuple[int, str, str]]) -> pa.RecordBatch:
        counts, own, back = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())], names=names)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            found = []
            for _, texts in bpe._in_parts(batch.column(1)):
                for ids in vocabulary.encode_many(texts):
                    digest = _Digest()
                    digest.add(vocabulary, np.frombuffer(ids, dtype="<u4"))
                    found.append(digest.values())
            yield batch_of(batch.column(0), found)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, now, digest, own, copies = get(), None, _Digest(), None, 0
        for batch in batches:
            for i, (key, n, ids) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(4))):
                if key != now:
                    if now is not None:
                        yield batch_of(pa.concat_arrays([own] * copies), [digest.values()] * copies)
                    now, digest, own, copies = key, _Digest(), batch.column(1).slice(i, 1), n
                digest.add(vocabulary, vocabulary.numbers(ids.as_py()))
        if now is not None:
            yield batch_of(pa.concat_arrays([own] * copies), [digest.values()] * copies)

    pieces = long_pieces(long, path, chunk, overlap).select("__key", "id", "__copies", "__piece", "__ids")
    stitched = pieces.repartition("__key").sortWithinPartitions("__key", "__piece").mapInArrow(together, schema)
    return short.mapInArrow(alone, schema).unionByName(stitched).withColumnRenamed("id", id)


def encode_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`id` and ids (array<int>) of every row, under the rules of `round_trip`."""
    get = _vocabulary(docs, path)
    short, long = _parted(docs, id, text, chunk, overlap)
    kind = docs.schema[id].dataType.simpleString()

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            found = [np.frombuffer(ids, dtype="<i4") for _, texts in bpe._in_parts(batch.column(1)) for ids in vocabulary.encode_many(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["id", "ids"])

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [get().numbers(x.as_py()).astype(np.int32) for x in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(pa.int32()))], names=["__key", "id", "__copies", "__piece", "ids"])

    pieces = long_pieces(long, path, chunk, overlap).select("__key", "id", "__copies", "__piece", "__ids").mapInArrow(numbers, f"__key string, id {kind}, __copies bigint, __piece int, ids array<int>")
    whole = pieces.groupBy("__key").agg(F.first("id").alias("id"), F.first("__copies").alias("n"), F.array_sort(F.collect_list(F.struct("__piece", "ids"))).alias("x"))
    each = whole.select("id", F.flatten("x.ids").alias("ids"), F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).select("id", "ids")
    return short.mapInArrow(alone, f"id {kind}, ids array<int>").unionByName(each).withColumnRenamed("id", id)


def decode_documents(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`id` and bytes (binary) of every row of ids; null ids decode to no bytes."""
    get, kind = _vocabulary(encoded, path), encoded.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b"".join(map(vocabulary.bytes_of.__getitem__, x.as_py() or [])) for x in batch.column(1)], pa.binary())], names=[id, "bytes"])

    return encoded.select(id, ids).mapInArrow(run, f"`{id}` {kind}, bytes binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: digests of every row of documents, as `round_trip` defines them."""
    if public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}") != bpe.WORDS:
        raise ValueError("the public pattern is not the one for which boundaries are proven")
    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
