"""Registry of the training-data operators' queries and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, fingerprints, forest, langid, licenses, lm_score, minhash, packing, repair, runs, sharding, surrogates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pseudo_likelihood": lm_score.op1_pseudo_likelihood,
    "op2_minhash_near_dedup": minhash.op2_minhash_near_dedup,
    "op3_pii_surrogates": surrogates.op3_pii_surrogates,
    "op4_bpe_transducer": bpe.op4_bpe_transducer,
    "op5_document_fingerprints": fingerprints.op5_document_fingerprints,
    "op6_projection_forest": forest.op6_projection_forest,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_chat_windows": chat.op8_chat_windows,
    "op9_extendible_shards": sharding.op9_extendible_shards,
    "op10_language_id": langid.op10_language_id,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_license_scan": licenses.op12_license_scan,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op2_minhash_near_dedup": minhash.ORACLE,
    "op6_projection_forest": forest.ORACLE,
    "op8_chat_windows": chat.ORACLE,
    "op9_extendible_shards": sharding.ORACLE,
    "op12_license_scan": licenses.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
}
