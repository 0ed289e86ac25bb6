"""The operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from basketry.llm import (
    decontaminate,
    filter_audit,
    languages,
    licenses,
    main_text,
    mixing,
    ngram_join,
    sentencepieces,
    token_files,
    top_k,
    toxicity,
    url_trust,
    vector_codes,
)

QUERIES = {
    "op1_url_trust": url_trust.op1,
    "op2_toxicity": toxicity.op2,
    "op3_ngram_join": ngram_join.op3,
    "op4_languages": languages.op4,
    "op5_sentencepieces": sentencepieces.op5,
    "op6_licenses": licenses.op6,
    "op7_main_text": main_text.op7,
    "op8_top_k": top_k.op8,
    "op9_token_files": token_files.op9,
    "op10_decontamination": decontaminate.op10,
    "op11_vector_codes": vector_codes.op11,
    "op12_mixing": mixing.op12,
    "op13_filter_audit": filter_audit.op13,
}

ORACLE = {
    "op8_top_k": top_k.OP8_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_vector_codes": vector_codes.OP11_SQL,
    "op12_mixing": mixing.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
