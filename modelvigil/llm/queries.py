"""The operators of this folder as registered queries, with SQL where SQL can express one."""

from __future__ import annotations

import corpus_pipeline
from modelvigil.llm import (
    clustering, html_text, language, mixing, near_vectors, packing, pii, secrets, simhash, spelling, token_file, topk,
    toxicity,
)

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_near_vectors": near_vectors.op2_near_vectors,
    "op3_html_text": html_text.op3_html_text,
    "op4_packing": packing.op4_packing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_language": language.op6_language,
    "op7_simhash": simhash.op7_simhash,
    "op8_secrets": secrets.op8_secrets,
    "op9_token_file": token_file.op9_token_file,
    "op10_mixing": mixing.op10_mixing,
    "op11_clustering": clustering.op11_clustering,
    "op12_pii": pii.op12_pii,
    "op13_spelling": spelling.op13_spelling,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_topk": topk.ORACLE,
    "op2_near_vectors": near_vectors.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_clustering": clustering.ORACLE,
}
