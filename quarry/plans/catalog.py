"""Imports every query module so that each registers its queries."""

from quarry.plans import (  # noqa: F401
    q_aggregate,
    q_evaluate,
    q_exact,
    q_facts,
    q_features,
    q_models,
    q_relational,
    q_scalar,
    q_sources,
    q_streaming,
    q_topn,
)
