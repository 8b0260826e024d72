"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from logweft.llm import bpe, chunks, ctw, infill, leaks, lines, neighbours, records, replies, resample, secrets, simhash, toxicity

QUERIES = {
    "op1_decontamination": leaks.op1_decontamination,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_context_tree": ctw.op3_context_tree,
    "op4_reply_trees": replies.op4_reply_trees,
    "op5_byte_bpe": bpe.op5_byte_bpe,
    "op6_chunk_dedup": chunks.op6_chunk_dedup,
    "op7_simhash": simhash.op7_simhash,
    "op8_cross_polytope": neighbours.op8_cross_polytope,
    "op9_secret_forest": secrets.op9_secret_forest,
    "op10_line_dedup": lines.op10_line_dedup,
    "op11_records": records.op11_records,
    "op12_resample": resample.op12_resample,
    "op13_infill": infill.op13_infill,
}
ORACLE = {"op4_reply_trees": replies.ORACLE, "op13_infill": infill.ORACLE}
