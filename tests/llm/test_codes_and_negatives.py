"""Byte-level BPE over chunks, hard negatives and vector codes against the library, SQL and brute force, on nulls, ties, repeats, lengths and empty tables."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from allelix.llm import bpe, byte_bpe, hard_negatives, queries, vector_codes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def odd_texts():
    r = random.Random(3)
    letters = "ab '’tsrevmld \u0085 \t\n\r12３é中ไทย́😀-.\x1c\x1d ßЖ"
    texts = ["".join(r.choices(letters, k=r.randint(0, 3000))) for _ in range(120)]
    texts += ["a" * 5000, " " * 3000 + "x", "\n" * 700 + " y", "it's " * 900, "'" * 1000 + "re", "中" * 4000, "7" * 3000 + "a", None, "", "<|endoftext|>"]
    return texts + texts[:4] + texts[-3:]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i % 30 else None, t, "x", 1) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, rows[1], rows[1]], "doc_id long, text string, n_tokens string, id int").repartition(3)


@pytest.mark.parametrize(("chunk", "overlap"), [(96, 24), (700, 64), (byte_bpe.CHUNK, byte_bpe.OVERLAP)])
def test_chunked_encoding_is_the_library_s(library, odd, chunk, overlap):
    found = byte_bpe.round_trip(odd, PATH, chunk=chunk, overlap=overlap)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = sorted((str(r.doc_id), *digests(library, r.text)) for r in odd.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()) == expected


def test_ids_and_bytes_come_back(library, odd):
    encoded = byte_bpe.encode_documents(odd, PATH, chunk=200, overlap=32)
    assert sorted((str(r.doc_id), list(r.ids)) for r in encoded.collect()) == sorted((str(r.doc_id), library.encode_ordinary(r.text or "")) for r in odd.collect())
    assert sorted(bytes(r.bytes) for r in byte_bpe.decode_documents(encoded, PATH).collect()) == sorted((r.text or "").encode() for r in odd.collect())


def test_a_long_text_is_stitched_and_not_joined(spark):
    """Ordinary text gives a piece for each chunk, a run without boundary one piece for all chunks that it fills."""
    text = "the cat sat on the mat, and 12 dogs ran. " * 400
    pieces = byte_bpe.long_pieces(spark.createDataFrame([(1, bytearray(text.encode()))], "id long, __text binary"), PATH, 500, 40)
    assert pieces.count() == -(-(len(text) - 40) // 500)
    run = byte_bpe.long_pieces(spark.createDataFrame([(1, bytearray(b"word " + b"z" * 4000 + b" end" * 100))], "id long, __text binary"), PATH, 500, 40)
    assert run.where("__piece = 0").count() == 1 and run.count() == 2


def test_boundaries_that_are_called_sure_are_boundaries_of_the_whole_text():
    with open(PATH, "rb") as f:
        vocabulary = byte_bpe.Ranks(f.read())
    for text in odd_texts():
        text = text or ""
        whole = {0}
        at = 0
        for part in vocabulary.cut_words(text):
            for w in part:
                at += len(w)
                whole.add(at)
        assert {m.start() for m in byte_bpe.SURE.finditer(text)} <= whole | {len(text)}


def test_whole_documents_are_encoded_and_an_empty_table_is_empty(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.queries()["op11_byte_bpe"](spark, DATA).collect()}
    assert found == {r.doc_id: digests(library, r.text) for r in docs.collect()}
    assert byte_bpe.round_trip(docs.limit(0), PATH).count() == 0 and byte_bpe.encode_documents(docs.limit(0), PATH).count() == 0
    assert public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}") == bpe.WORDS


def duck(folder, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet{'' if folder == DATA else '/*.parquet'}'")
    cursor = con.execute(queries.oracle_sql()[name])
    return [x[0] for x in cursor.description], cursor.fetchall()


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    """Ties, zero and equal vectors, nulls in every column, non-finite components, clashing columns; ids not repeated, as SQL takes them."""
    x = np.random.default_rng(4).standard_normal((300, 16)).round(1)
    rows = [(i, v, None if i % 41 == 5 else i % 3) for i, v in enumerate(x.tolist())]
    rows += [(i, x[i % 4].tolist(), i % 4) for i in range(300, 340)] + [(400, [0.0] * 16, 1), (401, None, 1), (402, [None, *x[0][1:].tolist()], 2), (403, [float("nan")] * 16, 2), (450, [float("inf")] * 16, 0)]
    at = tmp_path_factory.mktemp("vectors")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("q"), "v": F.lit(1), "n": F.lit("w"), "code": F.lit(2)}).repartition(4).write.parquet(f"{at}/embeddings.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_vector_codes"])
@pytest.mark.parametrize("tables", ["given", "odd"])
def test_queries_say_what_sql_says(spark, vectors, name, tables):
    folder = DATA if tables == "given" else vectors
    found = queries.queries()[name](spark, folder)
    have, expected = duck(folder, name)
    assert sorted(have) == sorted(found.columns) and expected
    assert sorted(map(tuple, found.select(*have).collect())) == sorted(expected)


def brute_negatives(rows):
    """Rows (id, label, v) with integers, by definition."""
    out = []
    for a, la, va in rows:
        if a % 50:
            continue
        score = [(-int(va @ v), i, la == lb) for i, lb, v in rows if i != a]
        for p, pid, _ in sorted(x for x in score if x[2])[:5]:
            inside = sorted((s, i) for s, i, same in score if not same and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i) in enumerate(inside[:3])]
    return sorted(out)


def test_negatives_of_many_blocks_and_huge_components(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK_VECTORS", 50)
    x = np.random.default_rng(5).standard_normal((500, 8))
    frame = lambda v: spark.createDataFrame([(i, r, i % 4) for i, r in enumerate(v.tolist())], "vec_id long, embedding array<double>, label int")
    for v, scaled in ((x, np.floor(256 * x)), (x * 1e5, np.floor(256 * (x * 1e5)))):
        label = lambda i: (i % 4 + 1) % 10 if i % 7 == 0 else i % 4
        rows = [(i, label(i), r.astype(object)) for i, r in enumerate(scaled.astype(np.int64))]
        found = hard_negatives.mine(hard_negatives.usable(frame(v)))
        assert sorted(map(tuple, found.collect())) == brute_negatives(rows)


def test_bounds_spare_products_where_anchors_are_alike():
    """Clustered anchors: most candidates lie outside every window by their bounds alone, and the rows are those of brute force."""
    r = np.random.default_rng(6)
    centres = r.standard_normal((4, 12)) * 300
    v = np.floor(np.concatenate([c + r.standard_normal((150, 12)) * 4 for c in centres])).astype(np.int64)
    ids, labels = np.arange(600), np.arange(600) % 2
    anchors = np.arange(0, 150, 5)
    block = hard_negatives.Scores(ids, labels, v, v[anchors])
    for i, rows, scores in block.positives(anchors, labels[anchors], 5):
        exact = [(-int(v[anchors[i]] @ v[j]), j) for j in ids if labels[j] == labels[anchors[i]] and j != anchors[i]]
        assert [(-s, j) for j, s in zip(rows, scores)] == sorted(exact)[:5]
    assert block.rescored < 0.5 * 300 * len(anchors)
    tree = hard_negatives.spanning_tree(v[anchors].astype(float))
    assert sorted(n for n, _, _ in tree) == list(range(len(anchors))) and [p for _, p, _ in tree].count(-1) == 1


def test_negatives_with_repeats_unlike_lengths_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.75, 0.25], 2), (3, [1.0], 1), (None, [1.0, 1.0], 1), (50, [], 3), (51, [], 3)]
    one = hard_negatives.mine(hard_negatives.usable(spark.createDataFrame(rows, schema)))
    both = hard_negatives.mine(hard_negatives.usable(spark.createDataFrame(rows * 3, schema)))
    assert one.collect() == both.collect()
    assert hard_negatives.mine(hard_negatives.usable(spark.createDataFrame([], schema))).count() == 0
    assert [hard_negatives.window(p) for p in (10, 11, 0, -10)] == [(5, 9), (6, 10), (0, 0), (-5, -10)]


def test_slices_leave_the_nearest_entries(vectors):
    r = np.random.default_rng(8)
    for k in (1, 2, 16, 64):
        entries, parts = r.integers(-40, 40, (k, 5)), r.integers(-60, 60, (400, 5))
        entries[k // 2] = entries[0]
        book = vector_codes.Slices(entries)
        distance = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        found, least = book.nearest(parts)
        assert (found == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
        near = entries[r.integers(0, k, 400)] + r.integers(-3, 4, (400, 5))
        if k == 64:
            assert np.bitwise_count(book.candidates(near)).mean() < k / 2
    with pytest.raises(ValueError):
        vector_codes.Slices(np.zeros((65, 2), dtype=np.int64))


def test_codes_of_few_rows_repeats_unlike_lengths_and_no_rows(spark):
    schema = "vec_id long, embedding array<double>, label int"
    few = [(5, [0.1] * 8, 1), (5, [0.1] * 8, None), (None, [0.2] * 8, None), (7, [0.5, 0.5], 2), (8, [], 2), (9, [1e300, -1e300], 2), (10, None, 2)]
    coded, books = vector_codes.compress(spark.createDataFrame(few, schema))
    out = coded.collect()
    assert len(out) == 6 and books.shape == (8, 6, 1)
    assert all(r.error == 0 for r in out) and {r.code for r in out if r.vec_id == 5} == {"00" * 8}
    back = {str(r.vec_id): list(r.v) for r in vector_codes.decode(coded, books).collect()}
    assert back["5"] == [409] * 8 and back["7"] == [2048, 2048] + [0] * 6 and back["9"][:2] == [vector_codes.MOST, -vector_codes.MOST]
    assert vector_codes.compress(spark.createDataFrame([], schema))[0].count() == 0


def test_matrix_reads_slices_of_batches():
    column = pa.array([[1, 2], [3], [], [4, 5]], pa.list_(pa.int32())).slice(1)
    assert vector_codes._matrix(column, 3).tolist() == [[3, 0, 0], [0, 0, 0], [4, 5, 0]]
