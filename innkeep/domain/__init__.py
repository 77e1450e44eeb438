"""The package's queries over a set of test tables, with their SQL equivalents."""

from importlib import import_module

MODULES = ("columns", "rows", "documents", "marts", "operations", "tables", "landing", "intervals", "upkeep")


def load_queries():
    """(queries, SQL) of all query modules."""
    from innkeep.domain import registry

    for name in MODULES:
        import_module(f"innkeep.domain.queries_{name}")
    return registry.QUERIES, registry.ORACLES
