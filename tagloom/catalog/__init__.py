"""Queries over the given tables, one per operator."""


def load() -> None:
    """Register every query."""
    from . import modelling, relational  # noqa: F401
