"""Registered queries and the job recipes built from the operators."""

from importlib import import_module

MODULES = ("queries_aggregate", "queries_tokens", "queries_tables", "queries_pages",
           "queries_models", "queries_jobs")


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"lodestone.plans.{name}")
