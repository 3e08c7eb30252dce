"""The registered queries of the corpus operators, and their DuckDB SQL."""

from __future__ import annotations

from reelpulse.llm import (
    backoff,
    balltree,
    decontaminate,
    ffd_packing,
    jaccard_join,
    licenses,
    merkle,
    mix,
    packing,
    phrases,
    pu_quality,
    shards,
    token_count,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_stupid_backoff": backoff.op2_stupid_backoff,
    "op3_token_counts": token_count.op3_token_counts,
    "op4_balltree_topk": balltree.op4_balltree_topk,
    "op5_virtual_slots": shards.op5_virtual_slots,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_pu_quality": pu_quality.op7_pu_quality,
    "op8_license_index": licenses.op8_license_index,
    "op9_pack_token_ids": packing.op9_pack_token_ids,
    "op10_systematic_mix": mix.op10_systematic_mix,
    "op11_phrases": phrases.op11_phrases,
    "op12_ffd_packing": ffd_packing.op12_ffd_packing,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE = {
    "op1_jaccard_join": jaccard_join.ORACLE_OP1,
    "op2_stupid_backoff": backoff.ORACLE_OP2,
    "op4_balltree_topk": balltree.ORACLE_OP4,
    "op6_decontaminate": decontaminate.ORACLE_OP6,
    "op8_license_index": licenses.ORACLE_OP8,
    "op10_systematic_mix": mix.ORACLE_OP10,
    "op11_phrases": phrases.ORACLE_OP11,
    "op13_merkle_manifest": merkle.ORACLE_OP13,
}
