"""Registered queries, their inputs derived from the driver tables, and the SQL they match."""


def all_queries():
    """(queries, oracles) of every group."""
    from eventmart.plans import (  # noqa: F401
        attribution,
        documents,
        engagement,
        streams,
        tables,
    )
    from eventmart.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
