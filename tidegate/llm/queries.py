"""The registered queries of this package, and SQL twins where SQL can express them."""

from __future__ import annotations

from tidegate.llm import collocations, contamination, conversation_trie, repeated_windows
from tidegate.llm.collocations import op13_collocations
from tidegate.llm.contamination import op8_contamination
from tidegate.llm.conversation_trie import op12_conversation_trie
from tidegate.llm.language import op3_language
from tidegate.llm.licenses import op7_licenses
from tidegate.llm.mixing import op9_mixing
from tidegate.llm.quality import op1_quality
from tidegate.llm.repeated_bytes import op2_repeated_bytes
from tidegate.llm.repeated_windows import op5_repeated_windows
from tidegate.llm.secrets import op6_secrets
from tidegate.llm.simhash_groups import op4_simhash_groups
from tidegate.llm.token_counts import op11_token_counts
from tidegate.llm.weighted_simhash import op10_fingerprints

QUERIES = {
    "op1_quality": op1_quality,
    "op2_repeated_bytes": op2_repeated_bytes,
    "op3_language": op3_language,
    "op4_simhash_groups": op4_simhash_groups,
    "op5_repeated_windows": op5_repeated_windows,
    "op6_secrets": op6_secrets,
    "op7_licenses": op7_licenses,
    "op8_contamination": op8_contamination,
    "op9_mixing": op9_mixing,
    "op10_fingerprints": op10_fingerprints,
    "op11_token_counts": op11_token_counts,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL = {
    "op5_repeated_windows": repeated_windows.ORACLE_SQL,
    "op8_contamination": contamination.ORACLE_SQL,
    "op12_conversation_trie": conversation_trie.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
