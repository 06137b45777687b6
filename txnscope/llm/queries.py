"""Registry of the text operators: queries and their SQL (where SQL can express one)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, maxent, merkle, mixing, order_minhash, prefix_trie,
               quality, rans, separators, shingle_join, toxicity, warc, weighted_sampling)
from .oracle_sql import merkle_sql, prefix_trie_sql, shingle_join_sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        separators.op1_separator_scan,
        weighted_sampling.op2_weighted_sampling,
        rans.op3_rans_token_shards,
        mixing.op4_pivotal_mix,
        toxicity.op5_toxicity_grammar,
        decontaminate.op6_simhash_decontamination,
        maxent.op7_hashed_maxent,
        warc.op8_warc_transactions,
        quality.op9_pu_quality,
        order_minhash.op10_order_minhash,
        prefix_trie.op11_prefix_trie,
        shingle_join.op12_shingle_join,
        merkle.op13_merkle_manifest,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op11_prefix_trie": prefix_trie_sql(),
            "op12_shingle_join": shingle_join_sql(), "op13_merkle_manifest": merkle_sql()}
