"""Queries of the corpus operators, and the SQL of those that SQL can express."""

from clicklake.llm import (
    block_search,
    decontamination,
    fill_in_middle,
    language_id,
    licences,
    mixing,
    near_duplicates,
    quality,
    token_files,
    token_links,
    toxicity,
    url_rules,
    warc,
)

QUERIES = {
    "op1_url_filters": url_rules.op1_url_filters,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc": warc.op4_warc,
    "op5_licences": licences.op5_licences,
    "op6_quality": quality.op6_quality,
    "op7_mixing": mixing.op7_mixing,
    "op8_near_duplicates": near_duplicates.op8_near_duplicates,
    "op9_block_search": block_search.op9_block_search,
    "op10_token_files": token_files.op10_token_files,
    "op11_language_id": language_id.op11_language_id,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_token_links": token_links.op13_token_links,
}

ORACLES = {
    "op1_url_filters": url_rules.SQL,
    "op5_licences": licences.SQL,
    "op9_block_search": block_search.SQL,
    "op11_language_id": language_id.op11_language_id,
    "op12_fill_in_middle": fill_in_middle.SQL,
}
