"""The corpus queries ``opN_<name>(spark, sf_dir)`` and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from kestrel.llm import decontam, embed_dedup, html_main, language, merkle, mixing, ngram_join, pii, quality, suffix_dedup, token_align, toxicity, warc

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_decontamination": decontam.op2_decontamination,
    "op3_embedding_dedup": embed_dedup.op3_embedding_dedup,
    "op4_html_extraction": html_main.op4_html_extraction,
    "op5_quality": quality.op5_quality,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_pii": pii.op8_pii,
    "op9_warc": warc.op9_warc,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_token_align": token_align.op11_token_align,
    "op12_merkle": merkle.op12_merkle,
    "op13_language": language.op13_language,
}

ORACLE = {
    "op1_mixing": mixing.OP1_SQL,
    "op2_decontamination": decontam.OP2_SQL,
    "op9_warc": warc.OP9_SQL,
    "op12_merkle": merkle.OP12_SQL,
}
