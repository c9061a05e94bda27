"""Registry of this subpackage's queries and their SQL."""

from __future__ import annotations

from strandline.llm import filter_audit, line_windows, near_duplicates, raking, repeated_passages, url_filter
from strandline.llm.decontamination import op1_decontamination
from strandline.llm.filter_audit import op13_filter_audit
from strandline.llm.language_id import op10_language_id
from strandline.llm.line_windows import op6_line_windows
from strandline.llm.near_duplicates import op8_near_duplicates
from strandline.llm.personal_data import op5_personal_data
from strandline.llm.raking import op2_raking
from strandline.llm.repeated_passages import op7_repeated_passages
from strandline.llm.sharding import op11_sharding
from strandline.llm.spelling_variants import op12_spelling_variants
from strandline.llm.toxicity import op9_toxicity
from strandline.llm.url_filter import op4_url_filter
from strandline.llm.weighted_fingerprints import op3_weighted_fingerprints

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_raking,
        op3_weighted_fingerprints,
        op4_url_filter,
        op5_personal_data,
        op6_line_windows,
        op7_repeated_passages,
        op8_near_duplicates,
        op9_toxicity,
        op10_language_id,
        op11_sharding,
        op12_spelling_variants,
        op13_filter_audit,
    )
}

ORACLES = {
    "op2_raking": raking.SQL,
    "op4_url_filter": url_filter.SQL,
    "op6_line_windows": line_windows.SQL,
    "op7_repeated_passages": repeated_passages.SQL,
    "op8_near_duplicates": near_duplicates.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
