"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tillweave.llm.collocations import COLLOCATIONS_SQL, op13_collocations
from tillweave.llm.language import op10_language
from tillweave.llm.licenses import op9_license_scan
from tillweave.llm.merkle import MERKLE_SQL, op12_merkle_manifest
from tillweave.llm.mixing import op3_mixing
from tillweave.llm.packing import op2_packing
from tillweave.llm.passages import op5_suffix_dedup
from tillweave.llm.pii import op11_private_data
from tillweave.llm.sampling import op8_near_duplicates
from tillweave.llm.scan import op7_dimension_scan
from tillweave.llm.topk import TOP_K_SQL, op6_exact_top_k
from tillweave.llm.toxicity import op1_toxicity
from tillweave.llm.urls import op4_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_dimension_scan": op7_dimension_scan,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_license_scan": op9_license_scan,
    "op10_language": op10_language,
    "op11_private_data": op11_private_data,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op6_exact_top_k": TOP_K_SQL,
    "op12_merkle_manifest": MERKLE_SQL,
    "op13_collocations": COLLOCATIONS_SQL,
}
