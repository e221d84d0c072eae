"""The queries of this subpackage, for the entry module."""

from __future__ import annotations

from .chat import op9_chat
from .decontamination import op4_decontamination
from .embedding_dedup import op10_embedding_dedup
from .jaccard_join import op2_jaccard_join
from .lm_score import op13_lm_score
from .oracle import PHRASES, TRIE
from .packing import op1_packing
from .phrases import op11_phrases
from .prefix_trie import op12_prefix_trie
from .sharding import op7_sharding
from .token_counts import op3_token_counts
from .token_files import op8_token_files
from .toxicity import op5_toxicity
from .url_filter import op6_url_filter

QUERIES = {f.__name__: f for f in (op1_packing, op2_jaccard_join, op3_token_counts, op4_decontamination, op5_toxicity, op6_url_filter, op7_sharding, op8_token_files, op9_chat, op10_embedding_dedup, op11_phrases, op12_prefix_trie, op13_lm_score)}

#: The others aren't SQL: tokenizers, fitted models, ring placement, SHA-256 over bytes, links. tests/llm compares them with plain versions.
ORACLE_SQL: dict[str, str] = {"op11_phrases": PHRASES, "op12_prefix_trie": TRIE}
