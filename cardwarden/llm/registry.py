"""Queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from cardwarden.llm.common import table
from cardwarden.llm.decontaminate import OP4_SQL, op4_decontaminate
from cardwarden.llm.html_extract import op3_html_extract
from cardwarden.llm.manifest import OP11_SQL, op11_merkle_manifest
from cardwarden.llm.minhash import op7_near_duplicates
from cardwarden.llm.mixing import op10_mixing
from cardwarden.llm.periodic import op12_periodic_runs
from cardwarden.llm.pieces import op13_sentencepiece
from cardwarden.llm.quality import op5_quality
from cardwarden.llm.secrets import OP1_SQL, op1_secret_scan
from cardwarden.llm.suffix import op6_suffix_dedup
from cardwarden.llm.topk import OP2_SQL, op2_topk_search
from cardwarden.llm.toxicity import op8_toxicity
from cardwarden.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_secret_scan": lambda spark, d: op1_secret_scan(table(spark, d, "documents")),
    "op2_topk_search": lambda spark, d: op2_topk_search(table(spark, d, "embeddings")),
    "op3_html_extract": lambda spark, d: op3_html_extract(table(spark, d, "pages")),
    "op4_decontaminate": lambda spark, d: op4_decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op5_quality": lambda spark, d: op5_quality(table(spark, d, "documents"), table(spark, d, "labels")),
    "op6_suffix_dedup": lambda spark, d: op6_suffix_dedup(table(spark, d, "documents")),
    "op7_near_duplicates": lambda spark, d: op7_near_duplicates(table(spark, d, "documents")),
    "op8_toxicity": lambda spark, d: op8_toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_warc": lambda spark, d: op9_warc(table(spark, d, "pages")),
    "op10_mixing": lambda spark, d: op10_mixing(table(spark, d, "documents")),
    "op11_merkle_manifest": lambda spark, d: op11_merkle_manifest(table(spark, d, "documents")),
    "op12_periodic_runs": lambda spark, d: op12_periodic_runs(table(spark, d, "documents")),
    "op13_sentencepiece": lambda spark, d: op13_sentencepiece(table(spark, d, "documents")),
}

ORACLE = {
    "op1_secret_scan": OP1_SQL,
    "op2_topk_search": OP2_SQL,
    "op4_decontaminate": OP4_SQL,
    "op9_warc": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
}
