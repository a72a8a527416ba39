"""The queries of this subpackage, and the SQL that says the same where SQL can."""

from __future__ import annotations

from tallymart.llm.chat import OP2_SQL, op2_chat_format
from tallymart.llm.decontaminate import OP5_SQL, op5_benchmark_decontamination
from tallymart.llm.html_text import op4_html_extraction
from tallymart.llm.lm import op7_lm_scoring
from tallymart.llm.merkle import OP13_SQL, op13_merkle_manifest
from tallymart.llm.negatives import OP12_SQL, op12_hard_negatives
from tallymart.llm.packing import op3_packing
from tallymart.llm.quality import op9_quality_rules
from tallymart.llm.sanitise import op11_pii_disclosure
from tallymart.llm.sharding import op8_hilbert_sharding
from tallymart.llm.simhash import op6_simhash_near_dedup
from tallymart.llm.urlgraph import op1_url_filter
from tallymart.llm.warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_chat_format": op2_chat_format,
    "op3_packing": op3_packing,
    "op4_html_extraction": op4_html_extraction,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_hilbert_sharding": op8_hilbert_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
    "op11_pii_disclosure": op11_pii_disclosure,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op2_chat_format": OP2_SQL,
    "op5_benchmark_decontamination": OP5_SQL,
    "op10_warc": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
