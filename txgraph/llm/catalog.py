"""Registered queries of the package."""

from __future__ import annotations

from txgraph.llm import importance, pipelined_search, winnowing
from txgraph.llm.chat_threads import op8_chat_threads
from txgraph.llm.group_packing import op13_group_packing
from txgraph.llm.language_id import op4_language_id
from txgraph.llm.line_dedup import op3_line_dedup
from txgraph.llm.near_dedup import op2_near_dedup
from txgraph.llm.ngram_lm import op1_lm_score
from txgraph.llm.packing import op7_packing
from txgraph.llm.quality import op6_quality
from txgraph.llm.spotsigs import op9_fingerprints
from txgraph.llm.token_files import op5_token_files

QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_near_dedup": op2_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_chat_threads": op8_chat_threads,
    "op9_fingerprints": op9_fingerprints,
    "op10_decontamination": winnowing.op10_decontamination,
    "op11_ranked_search": pipelined_search.op11_ranked_search,
    "op12_importance": importance.op12_importance,
    "op13_group_packing": op13_group_packing,
}

#: The other queries are tested against brute force, as SQL cannot express them.
ORACLE: dict[str, str] = {
    "op10_decontamination": winnowing.ORACLE,
    "op11_ranked_search": pipelined_search.ORACLE,
    "op12_importance": importance.ORACLE,
}
