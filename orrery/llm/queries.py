"""The queries of this subpackage: one ``opN_*`` per operator."""

from __future__ import annotations

from .byte_bpe import op2_byte_bpe
from .collocations import ORACLE as PHRASE_ORACLE
from .collocations import op12_phrases
from .conversation_trie import ORACLE as TRIE_ORACLE
from .conversation_trie import op11_conversation_trie
from .iblt import op4_fingerprints
from .jaccard_join import ORACLE as JACCARD_ORACLE
from .jaccard_join import op7_jaccard_join
from .line_dedup import ORACLE as LINE_ORACLE
from .line_dedup import op8_line_dedup
from .link_trust import ORACLE as TRUST_ORACLE
from .link_trust import op13_link_trust
from .maxent_lm import op1_maxent_lm
from .media import op5_media_archives
from .packing import op10_packing
from .pii import op3_pii_anchors
from .quality_gam import op9_quality_gam
from .suffix_dedup import ORACLE as SUFFIX_ORACLE
from .suffix_dedup import op6_suffix_dedup

QUERIES = {
    "op1_maxent_lm": op1_maxent_lm,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_pii_anchors": op3_pii_anchors,
    "op4_fingerprints": op4_fingerprints,
    "op5_media_archives": op5_media_archives,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_gam": op9_quality_gam,
    "op10_packing": op10_packing,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_phrases": op12_phrases,
    "op13_link_trust": op13_link_trust,
}

#: SQL that returns the same rows, for the operators that SQL can express.
ORACLES: dict[str, str] = {"op6_suffix_dedup": SUFFIX_ORACLE, "op7_jaccard_join": JACCARD_ORACLE, "op8_line_dedup": LINE_ORACLE, "op11_conversation_trie": TRIE_ORACLE, "op12_phrases": PHRASE_ORACLE, "op13_link_trust": TRUST_ORACLE}
