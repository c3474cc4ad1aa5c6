"""All registered queries. Importing a query module registers its queries."""

from signalflow.plans import q_counts, q_features, q_models, q_posts, q_signals, q_sources, q_streaming, q_text  # noqa: F401
from signalflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
