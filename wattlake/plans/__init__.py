from importlib import import_module

_QUERY_MODULES = ("telemetry_queries", "operator_queries", "quality_queries", "lake_queries", "change_queries", "file_queries")


def load_queries():
    """All registered queries and, where there is one, their equivalent SQL."""
    for module in _QUERY_MODULES:
        import_module(f"wattlake.plans.{module}")
    registry = import_module("wattlake.plans.registry")
    return registry.QUERIES, registry.EQUIVALENT_SQL
