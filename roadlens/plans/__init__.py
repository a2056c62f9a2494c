"""Query plans over the driver's tables: the telemetry view, processed
tables, registered queries and their DuckDB oracles."""

QUERY_MODULES = ("q_rows", "q_serving", "q_alerts", "q_features", "q_stream", "q_ml")


def load_registry():
    """Import every query module (each registers its queries) and return the
    registry module."""
    import importlib

    from roadlens.plans import registry

    for m in QUERY_MODULES:
        try:
            importlib.import_module(f"roadlens.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"roadlens.plans.{m}":
                raise
    return registry
