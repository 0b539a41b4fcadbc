"""Token counts of whole texts with a public tokenizer, by overlap resynchronisation.

Every text is counted in chunks that overlap; a text of one chunk is the case without overlap. Two neighbouring chunks are
spliced at a boundary inside their overlap at which a token begins in both and which is proven stable: no rule of the
tokenizer looks across it, so what lies before and after is encoded alike with any text on the other side. That this holds
after white space is read from the tokenizer file; a file for which it is not sure is refused. The tokens that both chunks
give between the first and the last such boundary must be the same. Where the overlap holds no such boundary (one word
longer than it), it is widened, twice as far each time, until there is one or the text ends.

Inside a chunk the same property gives the count: it is the sum over white-space-separated pieces, and each distinct piece
is encoded by the library once per worker.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from allelix.llm.common import in_small_batches, read_table, utf8

LIMIT = 2048
#: Characters of a chunk, and by which chunks overlap at first.
CHUNK, OVERLAP = 8192, 192
#: Pieces that a worker remembers, and characters of text that it counts at a time.
REMEMBERED, AT_ONCE = 400_000, 1 << 21
#: A word begins after ASCII white space.
AFTER_SPACE = re.compile(r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")

_loaded: dict[str, tuple] = {}


def proven_stable(spec: str) -> None:
    """Raise unless the tokenizer file shows that nothing looks across ASCII white space.

    Known to be safe: normal forms and lower case, white space replaced by a blank, a split that keeps only matches of a pattern
    without white space and without looking around, and special strings that hold no white space and take none with them.
    """
    def parts(x: dict | None, inner: str) -> list[dict]:
        return [] if x is None else [p for y in x[inner] for p in parts(y, inner)] if x["type"] == "Sequence" else [x]

    def refuse(why: str) -> None:
        raise ValueError(f"chunks cannot be spliced after white space: {why}")

    told = json.loads(spec)
    for x in parts(told.get("normalizer"), "normalizers"):
        blank = x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " "
        if x["type"] not in ("NFC", "NFD", "Lowercase") and not blank:
            refuse(f"normalizer {x['type']}")
    splits = 0
    for x in parts(told.get("pre_tokenizer"), "pretokenizers"):
        if x["type"] == "Split":
            pattern = x["pattern"].get("Regex", "")
            outside = re.sub(r"\[\^[^\]]*\]", "", pattern)
            if x["behavior"] != "Removed" or not x["invert"] or "(?" in pattern or "." in outside or " " in outside or "\\s" in outside or not all("\\s" in c for c in re.findall(r"\[\^[^\]]*\]", pattern)):
                refuse(f"split by {pattern}")
            splits += 1
        elif x["type"] != "ByteLevel" or x["add_prefix_space"] or x.get("use_regex"):
            refuse(f"pre-tokenizer {x['type']}")
    if not splits:
        refuse("no split")
    for x in told.get("added_tokens", ()):
        if re.search(r"\s", x["content"]) or x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]:
            refuse(f"special string {x['content']}")


def load(name: str, spec: str):
    """The library's tokenizer and what is remembered of it, once for each worker."""
    if name not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[name] = (tokenizer, {})
    return _loaded[name]


def token_spans(tokenizer, text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Where the tokens of text[start:end], encoded alone, begin and end in the whole text."""
    return [(a + start, b + start) for a, b in tokenizer.encode(text[start:end], add_special_tokens=False).offsets]


def splice(left: list[tuple[int, int]], right: list[tuple[int, int]], stable: list[int]) -> int | None:
    """The last stable boundary at which a token begins in both chunks and before which they agree from the first on."""
    begins = {a for a, _ in left} & {a for a, _ in right}
    common = [p for p in stable if p in begins]
    if not common:
        return None
    first, last = common[0], common[-1]
    between = lambda spans: [x for x in spans if first <= x[0] < last]
    if between(left) != between(right):
        raise ValueError("the tokenizer looks across a boundary that was taken for stable")
    return last


def cuts(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, boundary: re.Pattern = AFTER_SPACE) -> list[int]:
    """Where the chunks of a text are spliced, in order.

    Of each chunk only what lies in the overlap is encoded with offsets: the left one from its last stable boundary before the
    overlap, which gives the same tokens there as from its beginning; the right one from where it begins, in the middle of a word or not.
    """
    out, at, n = [], 0, len(text)
    while n - at > chunk + overlap:
        after, end, wide = at + chunk, at + chunk + overlap, overlap
        lead = max((m.start() for m in boundary.finditer(text, max(at, after - overlap), after)), default=at)
        while True:
            stable = [m.start() for m in boundary.finditer(text, after + 1, end)]
            cut = splice(token_spans(tokenizer, text, lead, end), token_spans(tokenizer, text, after, end), stable) if stable else None
            if cut is not None or end == n:
                break
            wide *= 2
            end = min(end + wide, n)
        if cut is None:
            break
        out.append(cut)
        at = cut
    return out


def count_pieces(tokenizer, memory: dict[bytes, int], texts: list[bytes]) -> list[int]:
    """The counts of chunks that begin and end at stable boundaries."""
    texts = [text.split() for text in texts]
    new = list(set().union(*texts).difference(memory)) if texts else []
    if len(memory) + len(new) > REMEMBERED:
        memory.clear()
        new = list(set().union(*texts))
    for at in range(0, len(new), 4096):
        part = new[at : at + 4096]
        memory.update(zip(part, map(len, tokenizer.encode_batch_fast([x.decode() for x in part], add_special_tokens=False))))
    return [sum(map(memory.__getitem__, pieces)) for pieces in texts]


def count_text(tokenizer, memory: dict[bytes, int], text: str, chunk: int = CHUNK, overlap: int = OVERLAP, boundary: re.Pattern = AFTER_SPACE) -> int:
    """The count of tokens of one text."""
    places = [0, *cuts(tokenizer, text, chunk, overlap, boundary), len(text)]
    return sum(count_pieces(tokenizer, memory, [text[a:b].encode() for a, b in zip(places, places[1:])]))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row.

    A null text counts as the empty text: no bytes, no tokens. Repeated rows stay; no other column is read, whatever its
    name; an empty table gives no rows. The tokenizer file, of fixed size, is read on the driver and sent to the executors.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        told = f.read()
    proven_stable(told)
    spec = docs.sparkSession.sparkContext.broadcast(told)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, memory = load(tokenizer_path, spec.value)
        for batch in batches:
            counts, sizes = [0] * batch.num_rows, []
            chunks, rows, size = [], [], 0

            def count() -> None:
                for j, c in zip(rows, count_pieces(tokenizer, memory, chunks)):
                    counts[j] += c
                chunks.clear()
                rows.clear()

            for i, x in enumerate(batch.column(1)):
                body = x.as_py()
                sizes.append(len(body))
                if len(body) <= CHUNK + OVERLAP:  # one chunk, whatever its characters
                    chunks.append(body)
                    rows.append(i)
                else:
                    whole = body.decode()
                    places = [0, *cuts(tokenizer, whole), len(whole)]
                    chunks += [whole[a:b].encode() for a, b in zip(places, places[1:])]
                    rows += [i] * (len(places) - 1)
                size += len(body)
                if size > AT_ONCE:
                    count()
                    size = 0
            count()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=[id, "n_bytes", "n_tokens", "over_limit"],
            )

    return in_small_batches(docs.select(id, utf8(text).alias("__text"))).mapInArrow(run, f"`{id}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the counts of every row of documents, as `count_tokens` defines them."""
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
