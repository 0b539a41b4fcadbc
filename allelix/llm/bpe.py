"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree are its adjacent symbol pairs, each with (rank, place) or nothing if the pair has no merge;
every inner node holds the lesser of its children. The root is the leftmost pair of the lowest rank. After a merge
three leaves change (the pair itself, the one before and the one after) and the nodes above them, so a merge costs a
logarithm of the word's length. Merging ends when the root is empty.

Words of like length are merged side by side: their trees are the rows of one array, and one step merges in each of
them. Longer words get a tree of their own. Each distinct word is merged once as long as a worker remembers it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from allelix.llm.common import in_small_batches, read_table, utf8

#: Bytes up to which words are merged side by side, and words in one array.
SIDE_BY_SIDE, ROWS = 128, 8192
#: Words that a worker remembers; characters of text and words of one huge text that it handles at a time.
REMEMBERED, AT_ONCE, WORDS_AT_ONCE = 200_000, 1 << 20, 1 << 18
NONE = np.iinfo(np.int64).max
#: The public pattern by which this kind of vocabulary cuts texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for texts of ASCII (but for separators 1C to 1F) and the Latin letters C0 to 24F, by a faster engine.
PLAIN = re.compile("[\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ɏ]*")
PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9À-ÖØ-öø-ɏ]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")


def byte_letters() -> dict[str, int]:
    """The printable letter by which a vocabulary file writes each byte: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and tokens of a byte-level vocabulary file, and the words merged so far."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = byte_letters()
        ids: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in token) for token, i in ids.items() if token not in self.special}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.of_byte = np.array([ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        key = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)[order]
        self.words = regex.compile(WORDS)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memory: dict[str, bytes] = {}

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs, rank -1 for a pair without a merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], -1), self.merged[at]

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of words of 2 to SIDE_BY_SIDE bytes."""
        longest = max(map(len, words))
        leaves = 1 << max(longest - 2, 0).bit_length()
        n, rows = len(words), np.arange(len(words))
        raw = np.frombuffer(b"".join(w.ljust(leaves + 1, b"\0") for w in words), dtype=np.uint8).reshape(n, leaves + 1)
        size = np.fromiter(map(len, words), dtype=np.int64, count=n)
        symbol = self.of_byte[raw]
        follows = np.tile(np.arange(1, leaves + 2), (n, 1))
        before = np.tile(np.arange(-1, leaves), (n, 1))
        gone = np.arange(leaves + 1) >= size[:, None]
        rank, joined = self.pair(symbol[:, :-1], symbol[:, 1:])
        place = np.arange(leaves)
        tree = np.full((n, 2 * leaves), NONE)
        tree[:, leaves:] = np.where((rank >= 0) & ~gone[:, 1:], rank << 32 | place, NONE)
        width = leaves
        while width > 1:
            tree[:, width // 2 : width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
            width //= 2
        active = rows[tree[:, 1] < NONE]
        while len(active):
            at = tree[active, 1] & 0xFFFFFFFF
            nxt = follows[active, at]
            after, prior = follows[active, nxt], before[active, at]
            symbol[active, at] = joined[active, at]
            gone[active, nxt] = True
            follows[active, at] = after
            ends = after >= size[active]
            tail = np.where(ends, 0, after)
            before[active[~ends], after[~ends]] = at[~ends]
            last = np.minimum(nxt, leaves - 1)  # the pair that began with the symbol merged away
            tree[active, leaves + last] = np.where(nxt < leaves, NONE, tree[active, leaves + last])
            rank, new = self.pair(symbol[active, at], symbol[active, tail])
            tree[active, leaves + at] = np.where((rank >= 0) & ~ends, rank << 32 | at, NONE)
            joined[active, at] = new
            has = prior >= 0
            a, p = active[has], prior[has]
            rank, new = self.pair(symbol[a, p], symbol[a, at[has]])
            tree[a, leaves + p] = np.where(rank >= 0, rank << 32 | p, NONE)
            joined[a, p] = new
            for who, leaf in ((active, last), (active, at), (a, p)):
                node = (leaves + leaf) >> 1
                for _ in range(leaves.bit_length() - 1):
                    tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
                    node >>= 1
            active = active[tree[active, 1] < NONE]
        flat, kept = symbol[~gone].astype("<u4").tobytes(), (~gone).sum(axis=1)
        ends = (np.cumsum(kept) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, word: bytes) -> bytes:
        """The same for one word of any length."""
        n = len(word)
        leaves = 1 << max(n - 2, 0).bit_length()
        symbol = self.of_byte[np.frombuffer(word, dtype=np.uint8)]
        rank, new = self.pair(symbol[:-1], symbol[1:])
        base = np.full(leaves, NONE)
        base[: n - 1] = np.where(rank >= 0, rank << 32 | np.arange(n - 1), NONE)
        levels = [base]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [0, *np.concatenate(levels[::-1]).tolist()]
        symbol, joined, follows, before = symbol.tolist(), new.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        none, alive, known = int(NONE), bytearray(b"\1" * n), self.known()

        def put(leaf: int, value: int) -> None:
            node = leaves + leaf
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        def look(leaf: int, after: int) -> int:
            found = known.get(symbol[leaf] << 32 | symbol[after])
            if found is None:
                return none
            joined[leaf] = found[1]
            return found[0] << 32 | leaf

        while tree[1] < none:
            at = tree[1] & 0xFFFFFFFF
            nxt = follows[at]
            after, prior = follows[nxt], before[at]
            symbol[at], follows[at], alive[nxt] = joined[at], after, 0
            if nxt < leaves:
                put(nxt, none)
            if after < n:
                before[after] = at
            put(at, look(at, after) if after < n else none)
            if prior >= 0:
                put(prior, look(prior, at))
        return np.array([s for s, a in zip(symbol, alive) if a], dtype="<u4").tobytes()

    def known(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_known"):
            self._known = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        return self._known

    def learn(self, words: set[str]) -> None:
        """Merge the words that are not yet remembered."""
        new = words.difference(self.memory)
        if len(self.memory) + len(new) > REMEMBERED:  # those in use now stay
            self.memory = {w: self.memory[w] for w in words & self.memory.keys()}
        by_size: dict[int, list[str]] = {}
        for w in new:
            by_size.setdefault(len(w.encode()), []).append(w)
        groups: dict[int, list[str]] = {}
        for size, found in by_size.items():
            if size == 1:
                self.memory.update((w, int(self.of_byte[ord(w)]).to_bytes(4, "little")) for w in found)
            elif size <= SIDE_BY_SIDE:
                groups.setdefault(max(size - 2, 0).bit_length(), []).extend(found)
            else:
                self.memory.update((w, self.merge_long(w.encode())) for w in found)
        for found in groups.values():
            for at in range(0, len(found), ROWS):
                part = found[at : at + ROWS]
                self.memory.update(zip(part, self.merge_rows([w.encode() for w in part])))

    def cut_words(self, text: str) -> Iterator[list[str]]:
        """Lists of words of a bounded number; a special string is a word of its own, marked by its place."""
        finder = PLAIN_WORDS if PLAIN.fullmatch(text) else self.words
        if len(text) <= AT_ONCE:
            yield finder.findall(text)
            return
        part = []
        for m in finder.finditer(text):
            part.append(m.group())
            if len(part) == WORDS_AT_ONCE:
                yield part
                part = []
        yield part

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, string): special strings are tokens as the library takes them by default."""
        if self.cut is None or not self.cut.search(text):
            yield False, text
            return
        for i, part in enumerate(self.cut.split(text)):
            if part:
                yield i % 2 == 1, part

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text in parts, as little-endian unsigned 32-bit integers."""
        for special, part in self.pieces(text):
            if special:
                yield self.special[part].to_bytes(4, "little")
                continue
            for words in self.cut_words(part):
                self.learn(set(words))
                yield b"".join(map(self.memory.__getitem__, words))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that fit into memory together."""
        cut = [[(special, part if special else next(self.cut_words(part))) for special, part in self.pieces(t)] for t in texts]
        self.learn(set().union(*(words for parts in cut for special, words in parts if not special)))
        get = self.memory.__getitem__
        return [b"".join(self.special[x].to_bytes(4, "little") if special else b"".join(map(get, x)) for special, x in parts) for parts in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_loaded: dict[str, Vocabulary] = {}


def load(path: str, spec: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(spec)
    return _loaded[path]


def known_form(spec: str) -> None:
    """Raise unless the tokenizer file is what this encoder does: byte-level words by the public pattern, merges, plain special strings."""
    told = json.loads(spec)
    cut, back, model = told.get("pre_tokenizer") or {}, told.get("decoder") or {}, told["model"]
    wrong = [
        name
        for name, fine in (
            ("normalizer", told.get("normalizer") is None), ("pre_tokenizer", cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)),
            ("decoder", back.get("type") == "ByteLevel"), ("model", model.get("type", "BPE") == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and not model.get("byte_fallback") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")),
            ("added_tokens", not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] and told.get("normalizer") for t in told.get("added_tokens", ()))),
        )
        if not fine
    ]
    if wrong:
        raise ValueError(f"no byte-level tokenizer of the known form: {', '.join(wrong)}")


def _vocabulary(docs: DataFrame, path: str):
    """A function that gives the vocabulary on an executor; the file, of fixed size, is read on the driver."""
    with open(path, encoding="utf-8") as f:
        told = f.read()
    known_form(told)
    spec = docs.sparkSession.sparkContext.broadcast(told)
    return lambda: load(path, spec.value)


def _in_parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch, so many at once that they stay small in memory; one larger than that comes alone."""
    first, part, size = 0, [], 0
    for i, x in enumerate(column):
        body = x.as_py().decode()
        if part and size + len(body) > AT_ONCE:
            yield first, part
            first, part, size = i, [], 0
        part.append(body)
        size += len(body)
    if part:
        yield first, part


def encode_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and ids (array<int>) of every row; a null text counts as the empty text and has no ids."""
    get, kind = _vocabulary(docs, path), docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            for first, texts in _in_parts(batch.column(1)):
                ids = [np.frombuffer(x, dtype="<i4") for x in vocabulary.encode_many(texts)] if len(texts) > 1 else [np.frombuffer(b"".join(vocabulary.encode(texts[0])), dtype="<i4")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(ids, pa.list_(pa.int32()))], names=[id, "ids"])

    return in_small_batches(docs.select(id, utf8(text).alias("__text"))).mapInArrow(run, f"`{id}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`id` and text of every row of ids; invalid UTF-8 decodes to replacement characters, null ids to the empty text."""
    get, kind = _vocabulary(encoded, path), encoded.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            texts = [vocabulary.decode(np.array(x.as_py() or [], dtype="<u4").tobytes()).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id, "text"])

    return encoded.select(id, ids).mapInArrow(run, f"`{id}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, then decoded, in one pass.

    A null text counts as the empty text. Repeated rows stay; no other column is read. Ids of a huge text are hashed
    and decoded part by part and never held together.
    """
    get, kind = _vocabulary(docs, path), docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = get()
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for _, texts in _in_parts(batch.column(1)):
                for parts in ([x] for x in vocabulary.encode_many(texts)) if len(texts) > 1 or len(texts[0]) <= AT_ONCE else [vocabulary.encode(texts[0])]:
                    n, ids_sum, text_sum = 0, hashlib.sha256(), hashlib.sha256()
                    kept = b""
                    for ids in parts:
                        n += len(ids) // 4
                        ids_sum.update(ids)
                        kept += vocabulary.decode(ids)
                        good = _whole(kept)
                        text_sum.update(kept[:good].decode("utf-8", "replace").encode())
                        kept = kept[good:]
                    text_sum.update(kept.decode("utf-8", "replace").encode())
                    counts.append(n)
                    ids_hash.append(ids_sum.hexdigest())
                    text_hash.append(text_sum.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)], names=[id, "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_small_batches(docs.select(id, utf8(text).alias("__text"))).mapInArrow(run, f"`{id}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _whole(data: bytes) -> int:
    """Length without a character cut off at the end."""
    for back in range(1, min(4, len(data)) + 1):
        lead = data[-back]
        if lead >= 0xC0:
            need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return len(data) - back if need > back else len(data)
        if lead < 0x80:
            break
    return len(data)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: digests of every row of documents, as `round_trip` defines them."""
    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
