"""Registered queries, one module per operator family."""

from importlib import import_module

FAMILIES = ("projections", "joins", "aggregates", "quality", "faults", "contracts", "privacy", "incremental", "modelling", "warehouse", "storage")


def load() -> None:
    """Import every family so that its queries are registered."""
    for family in FAMILIES:
        import_module(f"trackmetrics.plans.{family}")
