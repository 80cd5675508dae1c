"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from wordfold.llm.chat import q_chat
from wordfold.llm.decontaminate import q_decontamination
from wordfold.llm.merkle import q_fingerprints
from wordfold.llm.mixing import q_mixing
from wordfold.llm.negatives import q_negatives
from wordfold.llm.oracle import ORACLE_SQL
from wordfold.llm.pii import q_pii
from wordfold.llm.quality import q_quality
from wordfold.llm.scoring import q_scoring
from wordfold.llm.simhash import q_simhash
from wordfold.llm.substring import q_substring
from wordfold.llm.suffix import q_suffix
from wordfold.llm.variants import q_variants
from wordfold.llm.warc import q_warc

QUERIES = {
    "op1_quality": q_quality,
    "op2_suffix": q_suffix,
    "op3_chat": q_chat,
    "op4_scoring": q_scoring,
    "op5_warc": q_warc,
    "op6_mixing": q_mixing,
    "op7_decontamination": q_decontamination,
    "op8_pii": q_pii,
    "op9_substring": q_substring,
    "op10_simhash": q_simhash,
    "op11_negatives": q_negatives,
    "op12_fingerprints": q_fingerprints,
    "op13_variants": q_variants,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
