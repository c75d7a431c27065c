"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, conversations, divergence, jaccard_join, mixing, pii, quality_classifier, quality_rules, sentencepiece_bpe, simhash, toxicity, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_sentencepiece": sentencepiece_bpe.op3_sentencepiece,
    "op4_simhash": simhash.op4_simhash,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_mixing": mixing.op7_mixing,
    "op8_warc": warc.op8_warc,
    "op9_ann": ann.op9_ann,
    "op10_pii": pii.op10_pii,
    "op11_jaccard_join": jaccard_join.op11_jaccard_join,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op7_mixing": mixing.OP7_SQL,
    "op8_warc": warc.OP8_SQL,
    "op12_source_divergence": divergence.OP12_SQL,
}
