"""Queries over the driver tables, one or more per operator."""


def load():
    """Import every query module and return the registry."""
    from spherecube.queries import registry
    from spherecube.queries import catalog_queries, cell_queries, grid_queries, time_queries  # noqa: F401

    return registry
