"""Registry of the corpus queries opN_<name> and of the SQL that checks them."""

from __future__ import annotations

from . import bpe, decontam, license, pii, quality, shard, simhash, substring, tokencount, toxicity
from .oracles import oracle_sql

__all__ = ["oracle_sql", "queries"]


def queries():
    found = [
        toxicity.op1_kneser_ney_toxicity,
        simhash.op2_simhash_groups,
        decontam.op3_spaced_seed_leaks,
        substring.op4_substring_repeats,
        pii.op5_disclosure_spans,
        quality.op6_quality_rules,
        tokencount.op7_trie_token_counts,
        bpe.op8_byte_bpe,
        shard.op9_feistel_shards,
        license.op10_license_scan,
    ]
    return {f.__name__: f for f in found}
