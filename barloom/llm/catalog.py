"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from barloom.llm import (
    decision_list, jaccard_join, kd_shards, kneser_ney, merkle_manifest, packing, periodic_runs, pieces, recompression, secret_chain,
    site_lines, skip_chain, winnowing,
)

QUERIES = {
    "op1_skip_chain": skip_chain.query,
    "op2_pieces": pieces.query,
    "op3_packing": packing.query,
    "op4_decision_list": decision_list.query,
    "op5_winnowing": winnowing.query,
    "op6_recompression": recompression.query,
    "op7_kd_shards": kd_shards.query,
    "op8_site_lines": site_lines.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_kneser_ney": kneser_ney.query,
    "op11_secret_chain": secret_chain.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_merkle_manifest": merkle_manifest.query,
}

ORACLES = {"op8_site_lines": site_lines.ORACLE, "op13_merkle_manifest": merkle_manifest.ORACLE}
