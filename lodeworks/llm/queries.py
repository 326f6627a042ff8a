"""The queries of this subpackage by name, with their SQL where SQL can say it."""

from __future__ import annotations

from lodeworks.llm import (
    bpe,
    exact_dedup,
    hard_negatives,
    language_model,
    licenses,
    mixing,
    simhash,
    token_counts,
    token_files,
    toxicity,
    turn_repair,
    url_filter,
    winnowing,
)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_repair_token_files": token_files.op2_repair_token_files,
    "op3_simhash_tiles": simhash.op3_simhash_tiles,
    "op4_bpe_rank_queue": bpe.op4_bpe_rank_queue,
    "op5_mixing": mixing.op5_mixing,
    "op6_winnowing": winnowing.op6_winnowing,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_log_bilinear": language_model.op8_log_bilinear,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_turn_repair": turn_repair.op13_turn_repair,
}

ORACLE = {
    "op1_license_scan": licenses.OP1_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
}
