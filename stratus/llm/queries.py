"""Queries of the text operators, by name; __spark_entry__ adds them to its own.

Spelling variants and hard negatives have SQL. The others have none: checksums, hashes, automata, draws and fitted models are beyond it. tests/llm holds each against a
brute-force version, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

from stratus.llm.decontaminate import op9_greedy_tiling
from stratus.llm.langid import op10_ftrl_language
from stratus.llm.licenses import op8_rare_token_licences
from stratus.llm.media import op3_signature_sniffing
from stratus.llm.mixing import op11_multinomial_mixing
from stratus.llm.negatives import OP13_SQL, op13_approximation_file_negatives
from stratus.llm.packing import op4_cost_balanced_packing
from stratus.llm.pii import op5_crf_pii
from stratus.llm.quality import op7_boosted_quality
from stratus.llm.sharding import op1_virtual_slots
from stratus.llm.simhash import op6_multi_index_simhash
from stratus.llm.tokencount import op2_longest_match_tokens
from stratus.llm.variants import OP12_SQL, op12_errata_trie_variants


def queries() -> dict:
    named = [op1_virtual_slots, op2_longest_match_tokens, op3_signature_sniffing, op4_cost_balanced_packing, op5_crf_pii, op6_multi_index_simhash, op7_boosted_quality, op8_rare_token_licences, op9_greedy_tiling, op10_ftrl_language, op11_multinomial_mixing, op12_errata_trie_variants, op13_approximation_file_negatives]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {op12_errata_trie_variants.__name__: OP12_SQL, op13_approximation_file_negatives.__name__: OP13_SQL}
