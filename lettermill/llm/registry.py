"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, embeddings, exact_dedup, language, lm_scoring, minhash, mixing, packing, pii, substrings


def queries() -> dict:
    return {
        "op1_embeddings": embeddings.query,
        "op2_substrings": substrings.query,
        "op3_pii": pii.query,
        "op4_chat": chat.query,
        "op5_lm_scoring": lm_scoring.query,
        "op6_minhash": minhash.query,
        "op7_packing": packing.query,
        "op8_mixing": mixing.query,
        "op9_exact_dedup": exact_dedup.query,
        "op10_language": language.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_mixing": mixing.SQL, "op9_exact_dedup": exact_dedup.SQL}
