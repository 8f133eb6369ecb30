"""Queries of the operators in this package, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from callgrove.llm import bpe, chat, html, merkle, omh, packing, pii, quality, rtree, rules, shards, simhash, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    found = [
        toxicity.op1_toxicity,
        chat.op2_chat_format,
        omh.op3_order_minhash,
        quality.op4_quality,
        bpe.op5_bpe,
        simhash.op6_simhash,
        rules.op7_rules,
        html.op8_html,
        packing.op9_packing,
        shards.op10_shards,
        pii.op11_pii,
        rtree.op12_hard_negatives,
        merkle.op13_merkle,
    ]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return {
        "op2_chat_format": chat.OP2_SQL,
        "op12_hard_negatives": rtree.OP12_SQL,
        "op13_merkle": merkle.OP13_SQL,
    }
