"""Every registered training-data query on one small folder of tables: columns, types, whole results, and brute force where it is cheap.

The tables hold nulls in every column, empty and long texts, repeated rows, ties, and extra columns whose names clash with the operators' own.
"""

import hashlib
import json
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from allelix.llm import ann, mixing, pii, queries, sharding, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score int, base string, shard int, spans int, look int, sum int"
WORDS = ["alpha", "beta", "gamma", "delta", "Über", "naïve", "token", "x1", "die", "und"]


def rows():
    r = random.Random(21)
    texts = [" ".join(r.choices(WORDS, k=r.randint(0, 60))) for _ in range(70)]
    texts += [None, "", " \n ", texts[5], texts[5], " ".join(r.choices(WORDS, k=20_000)), "a@b.cc 10.0.0.1 4111 1111 1111 1111 +1 (555) 555-1234", "password=abcd1234efgh " + "0af3" * 10, "<|endoftext|> 中文"]
    out = [(i, t, None if i % 7 == 0 else "en", None if i % 9 == 0 else f"s{i % 4}", None if t is None else len(t), "x", 1, "y", 2, 3, 4, 5) for i, t in enumerate(texts)]
    return [*out, out[3], (3, "another text of id three", *out[3][2:]), (None, "no id", *[None] * 10), (None, None, *[None] * 10)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    data = rows()
    spark.createDataFrame(data, SCHEMA).coalesce(3).write.parquet(str(at / "documents.parquet"))
    labels = [(i, 1, int("token" in (t or "")) if i % 3 else 0, "z") for i, t, *_ in data if i is not None] + [(None, None, None, None), (4, 0, 1, "z")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").coalesce(1).write.parquet(str(at / "labels.parquet"))
    x = np.random.default_rng(2).standard_normal((120, 8)).tolist()
    vectors = [(i, v) for i, v in enumerate(x)] + [(200, x[3]), (201, x[3]), (202, None), (203, [0.0] * 8), (204, [None, *x[0][1:]]), (None, x[1]), (7, x[7])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("id", F.lit("q")).withColumn("rank", F.lit(1)).coalesce(2).write.parquet(str(at / "embeddings.parquet"))
    return str(at)


CONTRACT = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op4_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op5_minhash": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op6_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op7_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op9_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_types_and_whole_results(spark, folder, name):
    found = queries.queries()[name](spark, folder)
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    assert {c: kinds.get(c) for c in CONTRACT[name]} == CONTRACT[name]
    out = found.collect()
    if name == "op4_neighbours":
        usable = [(r.vec_id, np.array(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if r.vec_id is not None and r.embedding and None not in r.embedding and any(r.embedding)]
        got = {}
        for r in out:
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert set(got) == {i for i, _ in usable if i % 50 == 0}
        for q, hits in got.items():
            own = dict(usable)[q]
            cos = sorted({(-float(v @ own / np.linalg.norm(v) / np.linalg.norm(own)), i) for i, v in usable if i != q})
            assert [k for k, _, _ in sorted(hits)] == [1, 2, 3, 4, 5]
            assert all(abs(s + dict((i, c) for c, i in cos)[v]) < 1e-12 for _, v, s in hits) and len({v for _, v, _ in hits} & {i for _, i in cos[:5]}) >= 4
        return
    data = rows()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(d[0]) for d in data)
    texts = sorted((str(d[0]), d[1] or "") for d in data)
    if name == "op1_simhash":
        assert sum(r.fingerprint == "0" * 16 for r in out) == sum(not t.split() for _, t in texts)
    if name == "op2_sharding":
        assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts)
        assert {r.law for r in out} == {"bytes"} and all(0 <= r.shard < 16 and r.grown_shard is None for r in out)
        for shard in {r.shard for r in out}:
            assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    if name == "op3_mixing":
        words, source = {}, {}
        for d in data:
            words[d[3]] = words.get(d[3], 0) + len((d[1] or "").encode().split())
        names = sorted(words, key=lambda s: (s is None, s or ""))
        want = dict(zip(names, mixing.targets([words[n] for n in names])))
        for d in data:
            source.setdefault(d[0], set()).add(d[3])
        for r in out:
            assert 0 <= r.taken <= 2 * r.size
            assert any(r.source_size == words[s] and abs(r.target - want[s]) < 1e-6 for s in source[r.doc_id])
    if name == "op6_token_counts":
        assert sorted((str(r.doc_id), r.n_bytes) for r in out) == sorted((i, len(t.encode())) for i, t in texts)
    if name in ("op8_pii", "op9_secrets"):
        assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() or r.spans for r in out)
    if name == "op10_toxicity":
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_pipeline_on_tables_with_nulls_and_on_none(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for part in (docs, docs.limit(0)):
        now, left = part, []
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, folder)
            if i < 4:
                assert now.columns == docs.columns, name
                at = str(tmp_path / f"{name}{part is docs}")
                now.write.parquet(at)
                now = spark.read.parquet(at)
                left.append(now.count())
        if part is not docs:
            assert left == [0] * 4 and now.count() == 0
            continue
        # no word of these labels is toxic by itself, so all rows stay; copies, and the rows that share no text but emptiness, are one of each
        texts = {t or "" for _, t, *_ in rows()}
        assert left[0] == docs.count() and left[1] <= docs.count() and left[1] >= 0.9 * len({" ".join(t.lower().split()) for t in texts}) and left[2] == left[1]
        assert now.count() == left[3] > 0 and {len(r.ids) > 0 for r in now.collect() if r.ids is not None} >= {True}


def test_empty_tables_give_no_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    labels = spark.read.parquet(f"{folder}/labels.parquet").limit(0)
    vectors = ann.usable(spark.read.parquet(f"{folder}/embeddings.parquet").limit(0))
    assert toxicity.classified(docs, labels).count() == 0 and ann.nearest(vectors, vectors).count() == 0
    assert simhash.one_of_each(docs).count() == 0 and pii.find_spans(docs).count() == 0 and sharding.shard_documents(docs)[0].count() == 0


def test_ties_go_to_smaller_ids(spark):
    same = [(i, [1.0, 2.0]) for i in (0, 9, 8, 7, 6, 5, 4, 3)]
    vectors = ann.usable(spark.createDataFrame(same, "vec_id long, embedding array<double>"))
    found = sorted((r["rank"], r.vec_id) for r in ann.nearest(vectors.where("id = 0"), vectors).collect())
    assert found == [(1, 3), (2, 4), (3, 5), (4, 6), (5, 7)]


def test_map_of_slots_is_stored_by_version_and_key_law_moves_rows_only_to_new_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 30)) for i in range(3000)], "doc_id long, text string")
    placed, table = sharding.shard_documents(docs, shards=8)
    sizes = [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert max(sizes) < 1.1 * min(sizes)
    grown = sharding.rebalance(table, list(zip(table.bytes_of, table.rows_of)), shards=9)
    again, _ = sharding.shard_documents(docs, table=grown)
    moved = placed.select("doc_id", F.col("shard").alias("a")).join(again.select("doc_id", F.col("shard").alias("b")), "doc_id").where("a <> b")
    assert {r.b for r in moved.collect()} == {8}
    assert json.loads(json.dumps(table.rows()[0])) == list(table.rows()[0])


def test_tokenizer_files_of_another_form_are_refused():
    import public_tokenizers

    from allelix.llm import bpe

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.known_form(f.read())
