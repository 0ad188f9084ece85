"""Whole jobs built from the operators, and the registered queries."""


def all_queries() -> dict:
    from docsift.plans import queries_models, queries_profile, queries_text  # noqa: F401
    from docsift.plans.registry import QUERIES

    return QUERIES
