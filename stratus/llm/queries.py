"""One query per operator, over its whole table."""

from __future__ import annotations

from stratus.llm import ann, divergence, fill_middle, fingerprint, html_text, langid, licenses, mixing, neardup, packing, passages, token_counts, toxicity
from stratus.llm.common import table

QUERIES = {
    "op1_ann": lambda spark, sf_dir: ann.op1_ann(table(spark, sf_dir, "embeddings")),
    "op2_packing": lambda spark, sf_dir: packing.op2_packing(table(spark, sf_dir, "documents")),
    "op3_neardup": lambda spark, sf_dir: neardup.op3_neardup(table(spark, sf_dir, "documents")),
    "op4_fingerprint": lambda spark, sf_dir: fingerprint.op4_fingerprint(table(spark, sf_dir, "documents")),
    "op5_langid": lambda spark, sf_dir: langid.op5_langid(table(spark, sf_dir, "documents")),
    "op6_token_counts": lambda spark, sf_dir: token_counts.op6_token_counts(table(spark, sf_dir, "documents")),
    "op7_mix": lambda spark, sf_dir: mixing.op7_mix(table(spark, sf_dir, "documents")),
    "op8_licenses": lambda spark, sf_dir: licenses.op8_licenses(table(spark, sf_dir, "documents")),
    "op9_toxicity": lambda spark, sf_dir: toxicity.op9_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op10_passages": lambda spark, sf_dir: passages.op10_passages(table(spark, sf_dir, "documents")),
    "op11_html": lambda spark, sf_dir: html_text.op11_html(table(spark, sf_dir, "pages")),
    "op12_divergence": lambda spark, sf_dir: divergence.op12_divergence(table(spark, sf_dir, "documents")),
    "op13_fill_middle": lambda spark, sf_dir: fill_middle.op13_fill_middle(table(spark, sf_dir, "documents")),
}

ORACLE = {
    "op3_neardup": neardup.ORACLE,
    "op7_mix": mixing.ORACLE,
    "op11_html": lambda spark, sf_dir: html_text.op11_html(table(spark, sf_dir, "pages")),
    "op12_divergence": divergence.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
