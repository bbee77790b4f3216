"""The registered queries of this subpackage: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from .common import read
from . import chat, decontaminate, jaccard, lm_score, metric_join, mixing, pii, runs, token_shards, topk, toxicity, urls, whitening


def op1_toxicity(spark, sf_dir):
    return toxicity.op1_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_urls(spark, sf_dir):
    return urls.op9_urls(read(spark, sf_dir, "pages"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.op3_decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_pii(spark, sf_dir):
    return pii.op4_pii(read(spark, sf_dir, "documents"))


def op5_lm(spark, sf_dir):
    return lm_score.op5_lm(read(spark, sf_dir, "documents"))


def op6_jaccard(spark, sf_dir):
    return jaccard.op6_jaccard(read(spark, sf_dir, "documents"))


def op7_shards(spark, sf_dir):
    return token_shards.op7_shards(read(spark, sf_dir, "documents"))


def op8_mix(spark, sf_dir):
    return mixing.op8_mix(read(spark, sf_dir, "documents"))


def op10_chat(spark, sf_dir):
    return chat.op10_chat(read(spark, sf_dir, "conversations"))


def op2_topk(spark, sf_dir):
    return topk.op2_topk(read(spark, sf_dir, "embeddings"))


def op11_metric_join(spark, sf_dir):
    return metric_join.op11_metric_join(read(spark, sf_dir, "embeddings"))


def op12_runs(spark, sf_dir):
    return runs.op12_runs(read(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.op13_whitening(read(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {"op1_toxicity": op1_toxicity, "op3_decontaminate": op3_decontaminate, "op4_pii": op4_pii, "op5_lm": op5_lm, "op6_jaccard": op6_jaccard, "op7_shards": op7_shards, "op8_mix": op8_mix, "op9_urls": op9_urls, "op10_chat": op10_chat, "op2_topk": op2_topk,
            "op11_metric_join": op11_metric_join, "op12_runs": op12_runs, "op13_whitening": op13_whitening}


def oracle_sql() -> dict:
    return {"op8_mix": mixing.ORACLE, "op2_topk": topk.ORACLE, "op11_metric_join": metric_join.ORACLE}
