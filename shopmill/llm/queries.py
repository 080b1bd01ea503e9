"""The registered queries of the operators, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from shopmill.llm import (
    decontaminate, licenses, mixing, neighbours, packing, quality, ranked_search, repeats, shingle_join, store, token_counts, token_files, url_rules,
    vector_codes,
)

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_url_rules": url_rules.op3_url_rules,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_packing": packing.op6_packing,
    "op7_licenses": licenses.op7_licenses,
    "op8_shingle_join": shingle_join.op8_shingle_join,
    "op9_substring_dedup": repeats.op9_substring_dedup,
    "op10_quality": quality.op10_quality,
    "op11_mixing": mixing.op11_mixing,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

QUERIES = {name: store.prepared(query) for name, query in QUERIES.items()}

STATEMENTS = {
    "op3_url_rules": url_rules.STATEMENT,
    "op4_token_counts": token_counts.STATEMENT,
    "op5_neighbours": neighbours.STATEMENT,
    "op11_mixing": mixing.STATEMENT,
    "op12_ranked_search": ranked_search.STATEMENT,
    "op13_vector_codes": vector_codes.STATEMENT,
}
