"""The training-data queries and the SQL that gives the same rows."""

from __future__ import annotations

from . import ann, dac, mixing, packing, pii, quality, sharding, simhash, suffixes, toxicity

QUERIES = {
    "op1_minimax_sharding": sharding.op1,
    "op2_dp_packing": packing.op2,
    "op3_poisson_mixing": mixing.op3,
    "op4_rule_ledger": quality.op4,
    "op5_covering_simhash": simhash.op5,
    "op6_posting_lists": ann.op6,
    "op7_segment_toxicity": toxicity.op7,
    "op8_addressable_codes": dac.op8,
    "op9_information_pii": pii.op9,
    "op10_suffix_family": suffixes.op10,
}
ORACLES: dict[str, str] = {"op3_poisson_mixing": mixing.SQL, "op4_rule_ledger": quality.SQL}
