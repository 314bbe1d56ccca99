"""All registered queries of this package. Importing a query module registers what it defines."""

from goldleaf.llm import query_block_max_search, query_brown_lm, query_cotraining, query_lsh_forest, query_periodic_runs, query_poisson_mix, query_quality_rules, query_residual_packing, query_sentence_spans, query_stream_dedup, query_temporal_lists, query_token_counts, query_toxicity_chain  # noqa: F401
from goldleaf.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
