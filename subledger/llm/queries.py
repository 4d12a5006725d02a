"""Queries of this package: name -> (spark, folder of input tables) -> rows."""

from __future__ import annotations

from subledger.llm.decontamination import op10_positional_index
from subledger.llm.hard_negatives import op12_multi_index_negatives
from subledger.llm.html_text import op7_boosted_dom_text
from subledger.llm.language_model import op9_backoff_automaton
from subledger.llm.mixing import op6_water_filling
from subledger.llm.ngram_join import op1_ngram_join
from subledger.llm.periodic_runs import op11_periodic_runs
from subledger.llm.quality import op2_robust_outliers
from subledger.llm.sharding import op5_hypergeometric_shards
from subledger.llm.simhash import op13_simhash_groups
from subledger.llm.sql import ORACLES
from subledger.llm.suffix_dedup import op8_suffix_array_dedup
from subledger.llm.token_counts import op4_heap_bpe_counts
from subledger.llm.warc import op3_warc_round_trip

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_robust_outliers": op2_robust_outliers,
    "op3_warc_round_trip": op3_warc_round_trip,
    "op4_heap_bpe_counts": op4_heap_bpe_counts,
    "op5_hypergeometric_shards": op5_hypergeometric_shards,
    "op6_water_filling": op6_water_filling,
    "op7_boosted_dom_text": op7_boosted_dom_text,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_backoff_automaton": op9_backoff_automaton,
    "op10_positional_index": op10_positional_index,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_multi_index_negatives": op12_multi_index_negatives,
    "op13_simhash_groups": op13_simhash_groups,
}

__all__ = ["ORACLES", "QUERIES"]
