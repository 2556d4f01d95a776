"""The queries of this subpackage, by name, and the SQL answers of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    grouping, hilbert, neardup, negatives, ordermin, packing, pii, quality, resample, sharding,
    simple8b, tokens, toxicity,
)
from millrace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_order_minhash": lambda s, d: ordermin.edited_pairs(table(s, d, "documents")),
        "op2_boosted_pii": lambda s, d: pii.personal_data(table(s, d, "documents")),
        "op3_harmonic_packing": lambda s, d: packing.packed_pieces(table(s, d, "documents")),
        "op4_crf_quality": lambda s, d: quality.quality_scores(
            table(s, d, "documents"), table(s, d, "labels")),
        "op5_byte_bpe": lambda s, d: tokens.round_trip(table(s, d, "documents")),
        "op6_hilbert_neighbours": lambda s, d: hilbert.nearest(table(s, d, "embeddings")),
        "op7_minhash_inverted": lambda s, d: neardup.linked_documents(table(s, d, "documents")),
        "op8_mil_toxicity": lambda s, d: toxicity.toxicity_scores(
            table(s, d, "documents"), table(s, d, "labels")),
        "op9_simple8b": lambda s, d: simple8b.written_and_read(table(s, d, "documents")),
        "op10_hypergeometric_shards": lambda s, d: sharding.sharded(table(s, d, "documents")),
        "op11_maximus_negatives": lambda s, d: negatives.hard_negatives(table(s, d, "embeddings")),
        "op12_importance_resampling": lambda s, d: resample.resample(
            table(s, d, "documents"), table(s, d, "benchmark")),
        "op13_grouping_packing": lambda s, d: grouping.best_fit_pieces(table(s, d, "documents")),
    }


def statements() -> dict[str, str]:
    return {"op11_maximus_negatives": negatives.SQL, "op12_importance_resampling": resample.SQL}
