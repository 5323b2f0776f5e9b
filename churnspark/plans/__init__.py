"""Queries over the given tables, with the SQL they are checked against."""


def all_queries() -> None:
    """Import every module that registers queries."""
    from churnspark.plans import aggregates, cleaning, explaining, ingest, joins, modelling, ordered, streams  # noqa: F401
