"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import op3_chat, op5_exact, op8_topk, op11_repair, op12_trie, op13_quality
from .op1_tokens import op1_token_counts
from .op2_mixing import op2_source_mix
from .op3_chat import op3_chat_format
from .op4_toxicity import op4_toxicity
from .op5_exact import op5_exact_dedup
from .op6_secrets import op6_secret_scan
from .op7_jaccard import op7_ngram_jaccard
from .op8_topk import op8_exact_topk
from .op9_language import op9_language_id
from .op10_pack import op10_best_fit_pack
from .op11_repair import op11_structure_repair
from .op12_trie import op12_prefix_trie
from .op13_quality import op13_quality_rules


def queries():
    named = (op1_token_counts, op2_source_mix, op3_chat_format, op4_toxicity, op5_exact_dedup, op6_secret_scan, op7_ngram_jaccard, op8_exact_topk, op9_language_id, op10_best_fit_pack,
             op11_structure_repair, op12_prefix_trie, op13_quality_rules)
    return {f.__name__: f for f in named}


def oracle_sql():
    return {"op3_chat_format": op3_chat.SQL, "op5_exact_dedup": op5_exact.SQL, "op8_exact_topk": op8_topk.SQL, "op11_structure_repair": op11_repair.SQL, "op12_prefix_trie": op12_trie.SQL, "op13_quality_rules": op13_quality.SQL}
