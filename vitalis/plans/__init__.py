"""Registered queries and the shared plan shapes (ranks, quantiles) behind the operators."""

from importlib import import_module

QUERY_MODULES = [
    "core_queries",
    "learning_queries",
    "survey_queries",
    "vector_queries",
    "text_queries",
    "signal_queries",
    "model_queries",
    "source_queries",
]


def load_all() -> None:
    """Import every query module once, which fills the registry."""
    for name in QUERY_MODULES:
        import_module(f"vitalis.plans.{name}")
