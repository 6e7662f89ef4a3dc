"""Registered queries of this subpackage, and the SQL that checks those SQL can express."""

from __future__ import annotations

from dockplan.llm import bpe_chunks, chat, decontamination, kneser_ney, merkle, multi_index, ngram_join, pii, quality, sharding, spelling, token_store, toxicity
from dockplan.llm.oracle import ORACLE

QUERIES = {
    "op1_seed_and_align_decontamination": decontamination.op1_seed_and_align_decontamination,
    "op2_information_pii": pii.op2_information_pii,
    "op3_kneser_ney_scores": kneser_ney.op3_kneser_ney_scores,
    "op4_chunk_reuse_bpe": bpe_chunks.op4_chunk_reuse_bpe,
    "op5_kneser_ney_toxicity": toxicity.op5_kneser_ney_toxicity,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_event_sourced_chat": chat.op7_event_sourced_chat,
    "op8_perfect_hash_ids": token_store.op8_perfect_hash_ids,
    "op9_grouped_prefix_join": ngram_join.op9_grouped_prefix_join,
    "op10_rendezvous_sharding": sharding.op10_rendezvous_sharding,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_multi_index_neighbours": multi_index.op13_multi_index_neighbours,
}

__all__ = ["ORACLE", "QUERIES"]
