"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from allelix.llm import ann, bpe, byte_bpe, hard_negatives, minhash, mixing, pii, secrets, sharding, simhash, token_counts, toxicity, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.query,
        "op2_sharding": sharding.query,
        "op3_mixing": mixing.query,
        "op4_neighbours": ann.query,
        "op5_minhash": minhash.query,
        "op6_token_counts": token_counts.query,
        "op7_bpe": bpe.query,
        "op8_pii": pii.query,
        "op9_secrets": secrets.query,
        "op10_toxicity": toxicity.query,
        "op11_byte_bpe": byte_bpe.query,
        "op12_hard_negatives": hard_negatives.query,
        "op13_vector_codes": vector_codes.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_hard_negatives": hard_negatives.SQL, "op13_vector_codes": vector_codes.SQL}
