"""Queries of the corpus operators, for ``__spark_entry__``."""

from __future__ import annotations

import corpus_pipeline
from tessera.llm import cascade, negatives, ranking, sql
from tessera.llm.byte_bpe import op11_byte_bpe
from tessera.llm.class_lm import op1_class_lm
from tessera.llm.digests import op7_canonical_digest
from tessera.llm.lines import op8_prefix_join
from tessera.llm.mixing import op4_entropy_mix
from tessera.llm.near_dups import op10_bottom_k
from tessera.llm.packing import op3_best_fit
from tessera.llm.simple8b import op2_simple8b
from tessera.llm.substrings import op9_deep_shallow
from tessera.llm.toxicity import op5_compression_toxicity

QUERIES = {
    "op1_class_lm": op1_class_lm,
    "op2_simple8b": op2_simple8b,
    "op3_best_fit": op3_best_fit,
    "op4_entropy_mix": op4_entropy_mix,
    "op5_compression_toxicity": op5_compression_toxicity,
    "op6_cascade": cascade.op6_cascade,
    "op7_canonical_digest": op7_canonical_digest,
    "op8_prefix_join": op8_prefix_join,
    "op9_deep_shallow": op9_deep_shallow,
    "op10_bottom_k": op10_bottom_k,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_threshold": ranking.op12_threshold,
    "op13_norm_buckets": negatives.op13_norm_buckets,
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES: dict[str, str] = {"op6_cascade": cascade.SQL, "op8_prefix_join": sql.LINES, "op9_deep_shallow": sql.PASSAGES, "op10_bottom_k": sql.NEAR, "op12_threshold": ranking.SQL, "op13_norm_buckets": negatives.SQL}
